"""Sentiment enrichment of customer comments (the sandbox jobs).

* ``enrich`` — lexicon A label and score per comment, LEFT-joined to the
  customer dimension (name, nationkey); the output follows the sandbox
  table contract (custkey STRING, ..., score DOUBLE). One expression gives
  both label and score, so each text is scanned once.
* ``enrich_products`` — lexicon B score (FLOAT) and label for CSV-style
  comments, LEFT-joined to customer and part dimensions on ids parsed from
  the text columns (unparseable ids simply do not match).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sentiment as S

SANDBOX_COLUMNS = ("custkey", "customer_name", "nationkey", "comment", "predicted_label", "score")


def score_comments(comments: DataFrame, text_col: str = "comment") -> DataFrame:
    return S.with_lexicon(comments, text_col, "a", score_col="score",
                          label_col="predicted_label")


def enrich(comments: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """comments(custkey, comment) ⟕ dim_customer(custkey, name, nationkey)."""
    scored = score_comments(comments)
    cust = dim_customer.select(F.col("custkey").alias("_ck"), F.col("name").alias("customer_name"),
                               F.col("nationkey"))
    j = scored.join(cust, scored.custkey.cast("bigint") == cust._ck, "left")
    return j.select(F.col("custkey").cast("string").alias("custkey"), "customer_name",
                    "nationkey", "comment", "predicted_label", "score")


def enrich_products(comments: DataFrame, dim_customer_b: DataFrame,
                    dim_part_b: DataFrame) -> DataFrame:
    """comments(comment_id, customer_id, product_id, comment_text, ...) with
    lexicon-B sentiment ⟕ customers ⟕ parts. If the dimensions lack their
    key columns the comments are returned with sentiment only (explicit
    schema check instead of catching errors)."""
    scored = S.with_lexicon(comments, "comment_text", "b", score_col="sentiment_score",
                            label_col="sentiment")
    if "customer_key" not in dim_customer_b.columns or "part_key" not in dim_part_b.columns:
        return scored
    cust = dim_customer_b.select(F.col("customer_key").alias("_ck"), "customer_name")
    part = dim_part_b.select(F.col("part_key").alias("_pk"), "part_name")
    j = (scored.join(cust, F.expr("try_cast(customer_id AS BIGINT)") == cust._ck, "left")
         .join(part, F.expr("try_cast(product_id AS BIGINT)") == part._pk, "left"))
    return j.drop("_ck", "_pk")
