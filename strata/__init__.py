"""strata — lakehouse pipelines expressed as Spark DataFrame / SQL jobs.

Layers:
  sources/    readers: driver parquet tables, JDBC extracts, RAW delimited zone, comment generator
  sinks/      writers: by-name append, overwrite, partitioned, dynamic partition replace
  functions/  Column-level helpers: dates, exact money, safe casts, lexicon sentiment
  operators/  DataFrame operators: upsert (MERGE), dedup, as-of, checks, masking, retention
  plans/      pipelines and queries: benchmark queries, star schema, marts, refresh, ingest
  streaming/  Structured Streaming incremental ingestion with an idempotent upsert sink
"""

__version__ = "0.1.0"
