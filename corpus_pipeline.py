"""A corpus pipeline: toxicity, language, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps,
with the columns they came with; the last one returns the packed pieces.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import common, langid, ngram_join, packing, tokenizing, toxicity

#: Word tables and fitted models have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose clauses score below 0.5; null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels, ~toxicity.held_out()))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network recognises; texts without any
    letter go."""
    return langid.keep_known(docs, langid.train(docs, ~langid.held_out()))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near duplicates (five words, 0.8)."""
    return ngram_join.keep_one(docs, ngram_join.STAGE)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's pieces, placed in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizing.vocab_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_language),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
