"""Keyword (lexicon) sentiment as native Column expressions.

score = (number of positive words contained in lower(text))
      - (number of negative words contained in lower(text))

Containment is substring containment and each word counts at most once
per text ("fast" matches "breakfast"; "bad" and "good" cancel in "not too
bad, not too good"). NULL or empty text scores 0. The score is a sum of
``contains`` flags: it stays inside whole-stage codegen, no Python.

``with_lexicon`` lower-cases each text once in its own projection and
derives score and label from that column, so a long text is scanned once
per keyword and never re-lower-cased (Spark does not inline an expensive
column that is used many times).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The keyword lists of the scoring jobs, as published.
# Lexicon A (labels positive / negative / neutral, DOUBLE score)
LEXICON_A_POSITIVE = ["love", "excellent", "recommend", "great", "good", "satisfied",
                      "fast", "happy", "best"]
LEXICON_A_NEGATIVE = ["terrible", "bad", "not worth", "disappointed", "poor", "worse",
                      "unusable", "return"]
# Lexicon B (labels Positive / Negative / Neutral, FLOAT score)
LEXICON_B_POSITIVE = ["love", "excellent", "recommend", "exceeded", "good", "great", "fast"]
LEXICON_B_NEGATIVE = ["terrible", "not worth", "disappointed", "poor", "bad", "stopped"]
# Weak label: 1 when any of these occurs
WEAK_POSITIVE = ["great", "amazing", "excellent"]

LEXICONS = {"a": (LEXICON_A_POSITIVE, LEXICON_A_NEGATIVE, "double", False),
            "b": (LEXICON_B_POSITIVE, LEXICON_B_NEGATIVE, "float", True)}


def _flags(low: Column, words: Sequence[str]) -> Column:
    total = F.lit(0)
    for w in words:
        total = total + F.contains(low, F.lit(w)).cast("int")
    return total


def score_of_lower(low: Column, positive: Sequence[str], negative: Sequence[str]) -> Column:
    """Score from an already lower-cased text (NULL/empty → 0)."""
    s = _flags(low, positive) - _flags(low, negative)
    return F.when(low.isNull() | (low == ""), F.lit(0)).otherwise(s)


def lexicon_score(text: Column | str, positive: Sequence[str], negative: Sequence[str]) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return score_of_lower(F.lower(t), positive, negative)


def label_from_score(score: Column, capitalised: bool = False) -> Column:
    pos, neg, neu = ("Positive", "Negative", "Neutral") if capitalised else \
        ("positive", "negative", "neutral")
    return F.when(score > 0, pos).when(score < 0, neg).otherwise(neu)


def with_lexicon(df: DataFrame, text_col: str, lexicon: str = "a", *,
                 score_col: str = "score", label_col: str = "predicted_label") -> DataFrame:
    """Add score and label columns for ``lexicon`` ('a' or 'b')."""
    pos, neg, score_type, cap = LEXICONS[lexicon]
    low = df.withColumn("_low", F.lower(F.col(text_col)))
    scored = low.withColumn("_s", score_of_lower(F.col("_low"), pos, neg))
    return scored.withColumns({score_col: F.col("_s").cast(score_type),
                               label_col: label_from_score(F.col("_s"), cap)}).drop("_low", "_s")


def weak_label(text: Column | str) -> Column:
    """1 if the lower-cased text contains any weak-positive word, else 0."""
    t = F.col(text) if isinstance(text, str) else text
    low = F.lower(t)
    hit = F.lit(False)
    for w in WEAK_POSITIVE:
        hit = hit | F.contains(low, F.lit(w))
    return F.coalesce(hit, F.lit(False)).cast("int")
