"""Quality rules in DataFrame functions only (no Python on the executors).

Method: a hashed n-gram log-likelihood ratio. Two multinomials over hash
buckets are counted: the trusted target (texts labelled of good quality) and
the raw corpus (every text). Each n-gram of a text contributes
log(p_target / p_raw) of its bucket, and the sum is divided by the number of
n-grams, so length does not matter. A text is kept when it passes the base
rules and this mean is at least ``THRESHOLD``; the verdict of a text depends on
nothing but the text and the two counts.

The n-grams are each word's runs of ``N`` characters, at every place of the word
(``every``; a shorter word is one itself), as the query takes them; or, at less
cost, its characters from its head on, ``N`` by ``N`` (the last of a word may be
shorter), so that every character of a text is in one. Clean text of any language
of the target is near 0, and what junk adds to words (symbols, marks, separators),
wherever it stands, is far below.
"""
from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: characters of an n-gram, hash buckets, smoothing count, least mean ratio
N, BUCKETS, SMOOTH, THRESHOLD = 3, 1 << 15, 1.0, -0.5
#: bits of the table that tells which texts may be trusted
BITS = 1 << 25
#: fixed values of the contract
SPACE = r"[\x20\x09-\x0D]+"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 5


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def grams(text: Column, every: bool = False) -> Column:
    """N-grams of all words, in order; one pass over the text. With ``every``
    a match takes one character and looks ahead at its n-gram (``\\S`` is a
    character of words as ``SPACE`` parts them)."""
    found, group = rf"[^\x20\x09-\x0D]{{1,{N}}}", 0
    if every:
        found, group = rf"(?=(\S{{{N}}}|(?<!\S)\S{{1,{N - 1}}}(?!\S)))\S", 1
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(found), F.lit(group))


def bucket(gram: Column) -> Column:
    return F.xxhash64(gram).bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int")  # the hash modulo a power of two


def trusted_keys(labels: DataFrame) -> DataFrame:
    """Keys of all trusted documents."""
    return labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("long")).dropna().distinct()


def counted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(t, text) of every row: t is 1 for a trusted document. A bit table of the
    trusted keys' hashes, whose size is fixed (64 bits a row), is broadcast; only
    texts whose bit is set meet the keys themselves, so the others are not
    shuffled. These always meet by merge, at any size."""
    trusted = trusted_keys(labels)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    table = (trusted.select(F.floor(place / 64).alias("_word"), bit.alias("_bit"))
             .groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
             .withColumn("_word", F.when(F.col("doc_id").isNotNull(), F.floor(place / 64)))
             .join(F.broadcast(table), "_word", "left")
             .withColumn("_may", F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False)) & F.col("doc_id").isNotNull()))
    met = (texts.where("_may").select("doc_id", "text")
           .join(trusted.withColumn("_t", F.lit(1)).hint("merge"), "doc_id", "left")
           .select(F.coalesce("_t", F.lit(0)).alias("t"), "text"))
    return met.unionAll(texts.where(~F.col("_may")).select(F.lit(0).alias("t"), "text"))


def ratio_weights(docs: DataFrame, labels: DataFrame, every: bool = False) -> list[int]:
    """1000 * log(p_target / p_raw) of every bucket; zeros without any
    trusted document. The n-grams of every text are counted once; what reaches
    the driver is one row per bucket."""
    counted = (counted_texts(docs, labels)
               .select("t", F.explode(grams(F.col("text"), every)).alias("gram")).select("t", bucket(F.col("gram")).alias("b")))
    rows = counted.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target")).collect()
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for r in rows:
        raw[r["b"]], target[r["b"]] = r["raw"], r["target"]
    if not sum(target):
        return [0] * BUCKETS
    all_t, all_r = sum(target) + SMOOTH * BUCKETS, sum(raw) + SMOOTH * BUCKETS
    return [round(1000 * (math.log((t + SMOOTH) / all_t) - math.log((r + SMOOTH) / all_r)))
            for t, r in zip(target, raw)]


def rate(docs: DataFrame, weights: list[int], threshold: float = THRESHOLD, every: bool = False) -> DataFrame:
    """Base figures and verdict of every row (null text: no words). Windows of
    five words are told apart by a 64-bit hash."""
    table = F.from_json(F.lit(json.dumps(weights, separators=(",", ":"))), "array<int>")
    text = F.coalesce("_text", F.lit(""))
    d = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text"))
         .withColumn("_w", words(F.col("_text"))))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.select(
        "doc_id", F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
        F.get(F.transform(F.array(grams(F.col("_text"), every)), lambda gs: F.struct(  # the n-grams are made once
            F.aggregate(gs, F.lit(0).cast("long"), lambda s, g: s + F.get(table, bucket(g))).alias("sum"),
            F.size(gs).alias("n"))), F.lit(0)).alias("_sum"))
    d = d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "_sum",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_h") >= WINDOW, F.slice(F.transform(
            "_h", lambda h, i: F.xxhash64(h, *[F.get("_h", i + j) for j in range(1, WINDOW)])),
            F.lit(1), F.size("_h") - (WINDOW - 1))).alias("_win"))
    # few texts repeat a window: only theirs are sorted
    d = d.withColumn("_sorted", F.when(
        F.size("_win") > F.size(F.array_distinct("_win")),
        F.array_sort(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda p, j: F.coalesce(F.get("_sorted", j)["h"] == p["h"], F.lit(False))
    d = d.withColumn("_at", F.sort_array(F.transform(
        F.filter("_sorted", lambda p, i: same(p, i - 1) | same(p, i + 1)), lambda p: p["i"])))
    covered = F.aggregate(
        F.transform("_at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda s, x: s + x)
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    d = d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    d = d.withColumn("llr", F.when(F.col("n_words") > 0, F.col("_sum.sum") / (1000.0 * F.col("_sum.n")))
                     .otherwise(F.lit(0.0)))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"), "llr")


def quality_rules(docs: DataFrame, labels: DataFrame, every: bool = False) -> DataFrame:
    """Count both multinomials, then rate every document. Rows that repeat are
    rated each; an empty table gives an empty result."""
    return rate(docs, ratio_weights(docs, labels, every), every=every)
