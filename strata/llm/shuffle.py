"""Two-pass external shuffle of records into equal shards.

Pass one scatters every record, whole, to a bucket by a seeded hash of key and
text; a bucket is meant to fit in one task's memory (``bucket_bytes``). Records
that share key and text and together exceed a quarter of that are counted,
numbered and scattered one by one, so many equal records spread over buckets like
others. Pass two gives each bucket a Fisher-Yates shuffle from a generator seeded by (seed, bucket) and
writes it. A record's place in the whole order is its bucket's offset plus its
place in the bucket; records are dealt to shards by place, so the numbers of
rows of any two shards differ by at most one (law ``rows``).

The order depends on the rows and the seed alone, not on partitions or tasks:
a task that is run again writes the same rows. (Equal records are numbered, and
a bucket is sorted by all columns first.)
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BUCKET_BYTES = 24 << 20
#: 16 MB of bucket offsets, for 24 TB of records
BROADCAST_BUCKETS = 1 << 20
#: equal records that a task makes of one counted record
COPIES = 1000


def bucket_count(docs: DataFrame, bucket_bytes: int) -> int:
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    return max(1, -(-total // bucket_bytes))


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation: position i from the end swaps with a position
    drawn from 0 to i."""
    order = np.arange(n)
    draws = rng.integers(0, np.arange(n, 0, -1)).tolist() if n else []
    seq = order.tolist()
    for i, j in zip(range(n - 1, -1, -1), draws):
        seq[i], seq[j] = seq[j], seq[i]
    return np.array(seq, np.int64)


def _scattered(docs: DataFrame, payload: list[str], seed: int, buckets: int, bucket_bytes: int) -> DataFrame:
    """(r, bucket) of every record."""
    text = F.xxhash64("r.text")
    rows = docs.select(F.struct(*payload).alias("r")).withColumn("_h", F.xxhash64(F.lit(seed), F.col("r.doc_id"), text))
    size = F.coalesce(F.octet_length("r.text"), F.lit(0)) + 16
    # narrow rows, summed in the tasks first; at most four of these per bucket
    hot = (rows.groupBy("_h").agg(F.sum(size).alias("bytes")).where(F.col("bytes") * 4 > bucket_bytes)
           .select("_h", F.ceil(F.col("bytes") * 4 / F.lit(bucket_bytes)).alias("parts")))
    hot = common.written(hot, "hot")
    n = hot.count()
    by = lambda *h: F.pmod(F.xxhash64(*h), F.lit(buckets)).cast("int").alias("bucket")
    plain = F.pmod("_h", F.lit(buckets)).cast("int").alias("bucket")
    if not n:
        return rows.select("r", plain)
    hot = F.broadcast(hot) if n <= BROADCAST_BUCKETS else hot
    cold = rows.join(hot, "_h", "left_anti").select("r", plain)
    counted = rows.join(hot, "_h").groupBy("_h", "parts", "r").agg(F.count(F.lit(1)).alias("n"))
    step = F.lit(COPIES).cast("long")
    runs = counted.select("_h", "parts", "r", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)).alias("lo"))
    copies = runs.repartition("_h", "lo").select(
        "_h", "parts", "r", F.explode(F.sequence("lo", F.least(F.col("lo") + step, F.col("n")) - 1)).alias("copy"))
    spread = F.pmod(F.xxhash64(F.xxhash64("r"), "copy"), F.col("parts"))
    return cold.unionByName(copies.select("r", by("_h", spread)))


def write_shuffled(docs: DataFrame, path: str, shards: int = 40, seed: int = 17,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write the shuffled records of ``docs`` (all columns; needs ``doc_id``
    and ``text``) as Parquet under ``path`` and return them with ``shard`` and
    ``slot``, which replace input columns of these names. Null keys and texts, repeated rows and empty tables are allowed;
    equal rows are records like any other."""
    spark = docs.sparkSession
    buckets = bucket_count(docs, bucket_bytes)
    payload = [c for c in docs.columns if c not in ("shard", "slot")]
    scattered = _scattered(docs, payload, seed, buckets, bucket_bytes)
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("place", T.LongType()),
                           scattered.schema["r"]])

    def run(key, table):
        bucket = key[0].as_py()
        rows = table.column("r").combine_chunks()
        # rows reach a bucket in any order: sort first
        flat = [i for i in range(rows.type.num_fields) if not pa.types.is_nested(rows.type[i].type)]
        ids = pa.Table.from_arrays([rows.field(i) for i in flat], [str(i) for i in flat])
        first = pc.sort_indices(ids, sort_keys=[(str(i), "ascending") for i in flat])
        order = fisher_yates(len(rows), np.random.default_rng([seed, bucket]))
        taken = rows.take(first.take(pa.array(order)))
        return pa.Table.from_arrays([pa.array(np.full(len(rows), bucket, np.int32)),
                                     pa.array(np.arange(len(rows))), taken], ["bucket", "place", "r"])

    (scattered.groupBy("bucket").applyInArrow(run, schema)
     .write.parquet(f"{path}/buckets"))
    written = spark.read.schema(schema).parquet(f"{path}/buckets")
    # one row per bucket
    sizes = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    base = sizes.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("base"))
    # one row per bucket is broadcast up to a bound; beyond it the records are
    # shuffled once more
    base = F.broadcast(base) if buckets <= BROADCAST_BUCKETS else base
    at = F.col("base") + F.col("place")
    return (written.join(base, "bucket")
            .select("r.*", F.pmod(at, F.lit(shards)).cast("int").alias("shard"),
                    F.floor(at / F.lit(shards)).cast("long").alias("slot")))
