"""Synthetic customer comments generated on the executors.

``spark.range(n)`` gives ids on every executor; the customer, the class
(positive / negative / neutral with weights 0.4 / 0.3 / 0.3) and the text
are picked per row by an expression, so nothing passes through the driver
and the output is the same on every run.

``mode="hash"`` uses modular picks (identical in any SQL engine):
    custkey = (id * 7919) % customers
    class   = (id * 31) % 100   (< 40 positive, < 70 negative, else neutral)
    text    = (id * 17) % 10    within the class pool
``mode="random"`` uses Spark's seeded ``rand`` instead.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The comment pools (10 texts per class), as published.
POSITIVE_COMMENTS = [
    "Amazing flight experience!",
    "Loved the service and comfort.",
    "Excellent crew, smooth flight.",
    "Best airline I’ve flown with.",
    "Fantastic food and friendly staff.",
    "Quick boarding and comfortable seats.",
    "Everything was perfect.",
    "Loved the entertainment system.",
    "Very professional crew.",
    "Great value for money!",
]
NEGATIVE_COMMENTS = [
    "Horrible experience, flight delayed for hours.",
    "Seats were very uncomfortable.",
    "My luggage was lost and no one helped.",
    "Customer service was rude.",
    "The food was terrible.",
    "Long queues and poor management.",
    "Flight was cancelled without notice.",
    "Very noisy and dirty cabin.",
    "Crew ignored my requests.",
    "I’ll never fly with this airline again.",
]
NEUTRAL_COMMENTS = [
    "Average experience, nothing special.",
    "Flight was okay but could be better.",
    "Not too bad, not too good.",
    "Service was fine.",
    "Typical flight experience.",
    "The check-in process was normal.",
    "It was just another flight.",
    "Had an acceptable journey.",
    "Neutral impression overall.",
    "Flight time was as expected.",
]
CLASS_WEIGHTS = (0.4, 0.3, 0.3)


def generate_comments(spark: SparkSession, n: int, customers: int, *, mode: str = "hash",
                      seed: int = 42, num_partitions: int | None = None) -> DataFrame:
    """(custkey BIGINT, comment STRING), keys 1 to ``customers``, x n, spread over ``num_partitions``."""
    ids = spark.range(0, n, numPartitions=num_partitions) if num_partitions else spark.range(n)
    pools = {c: F.array(*[F.lit(s) for s in p]) for c, p in
             (("p", POSITIVE_COMMENTS), ("n", NEGATIVE_COMMENTS), ("u", NEUTRAL_COMMENTS))}
    idc = F.col("id")
    if mode == "hash":
        cust = F.pmod(idc * 7919, F.lit(customers)) + 1
        cls = F.pmod(idc * 31, F.lit(100))
        pick = F.pmod(idc * 17, F.lit(10)) + 1
        pos_cut, neg_cut = 40, 70
    elif mode == "random":
        cust = F.floor(F.rand(seed) * customers) + 1
        cls = F.floor(F.rand(seed + 1) * 100)
        pick = F.floor(F.rand(seed + 2) * 10) + 1
        pos_cut, neg_cut = int(CLASS_WEIGHTS[0] * 100), int((CLASS_WEIGHTS[0] + CLASS_WEIGHTS[1]) * 100)
    else:
        raise ValueError("mode must be 'hash' or 'random'")
    text = (F.when(cls < pos_cut, F.element_at(pools["p"], pick.cast("int")))
             .when(cls < neg_cut, F.element_at(pools["n"], pick.cast("int")))
             .otherwise(F.element_at(pools["u"], pick.cast("int"))))
    return ids.select(cust.cast("bigint").alias("custkey"), text.alias("comment"))
