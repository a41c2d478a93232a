import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.IntegerType())]
                      # names that the operators use themselves
                      + [T.StructField(c, T.StringType()) for c in (
                          "length", "piece", "bucket", "shard", "slot", "label", "known", "place", "set_id", "tile",
                          "_w", "_text", "_sum", "score", "n_tokens", "ids", "keys", "weight", "toxic", "r", "n")])

LONG = "wordy sentence, of the usual kind. " * 4000
ODD_TEXTS = [None, "", "   \n\t ", "a", "one two", LONG, "x" * 5000, "same text " * 30, "same text " * 30,
             "tabs\tand  runs\n\nof \x1c space<|endoftext|>!", "﻿Über 123 … ‘quoted’ _under_ don't", "中文文本 mixed text",
             "%%% ||| ***", "1234 5678"]


def table(spark, rows):
    """rows of (doc_id, text[, lang])"""
    width = len(SCHEMA.fields)
    full = [tuple([*r, *[None] * (width - len(r))]) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no key at all here"), (None, None), rows[4], rows[4], rows[7], (3, "another text with key three")]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return table(spark, odd_rows)


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, [])


@pytest.fixture(scope="session")
def small():
    import duckdb
    con = duckdb.connect()
    return con.execute("SELECT doc_id, text, lang FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY 1").fetchall()
