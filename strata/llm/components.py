"""Connected components of a link table, by alternating star contractions.

Each round replaces the links of every node by links to its smallest
neighbour (Kiveris et al., Connected Components in MapReduce and Beyond, 2014);
the links become stars around the smallest node of each component within
O(log^2 n) rounds. Links are made distinct and minima taken before they are
shuffled, so a node that most links share does not gather them; joins on it are
left to AQE. A round is written to shared storage, with a flag on each link
that tells whether it moved, and the table of the round before goes. Links
never leave the executors.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _round(links: DataFrame) -> tuple[DataFrame, bool]:
    """Large star, then small star, of links with a > b; and whether they
    were stars already."""
    least = (links.select(F.col("a").alias("node"), "b").unionByName(
        links.select(F.col("b").alias("node"), "b")).groupBy("node").agg(F.min("b").alias("low")))
    # large star: the greater end of a link goes to the smallest neighbour of the other
    large = (links.join(least, links["b"] == least["node"])
             .select("a", F.col("low").alias("b"), (F.col("low") != F.col("b")).alias("moved"))
             .groupBy("a", "b").agg(F.max("moved").alias("moved")))
    low = large.groupBy("a").agg(F.min("b").alias("low"))
    small = large.join(low, "a").select(
        F.explode(F.array(
            F.struct(F.col("a"), F.col("low").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"),
        (F.col("moved") | (F.col("b") != F.col("low"))).alias("moved"))
    out = common.written(small.where(F.col("e.a") != F.col("e.b")).select("e.a", "e.b", "moved")
                         .groupBy("a", "b").agg(F.max("moved").alias("moved")), "links")
    return out, bool(out.agg(F.max("moved")).first()[0])


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of its component, for every node of
    ``links`` (a, b). Self links and repeated links do no harm; no links give
    no rows. The rows are stored: ``common.forget`` removes them."""
    now = common.written(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")
    moved = True
    while moved:
        before = now
        now, moved = _round(now.select("a", "b"))
        common.forget(before)
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
    return common.stored_in(labels, *now._folders)
