"""Operators of a training-data pipeline. Nothing else in the library imports
this subpackage; its queries are registered by ``__spark_entry__`` when it can
be imported."""
