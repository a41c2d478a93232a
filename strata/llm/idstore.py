"""A store of token ids with keyed access.

Documents are range-partitioned and sorted by key; each task writes one shard,
two files on shared storage:

* ``<shard>-<attempt>.ids`` - the ids, nothing else, little-endian, 16 bits
  each where the vocabulary allows, else 32;
* ``<shard>-<attempt>.npz`` - the index: ``keys`` (key of each record in
  order), ``offsets`` (first id of each record, and the end), and a minimal
  perfect hash over the distinct keys with, for each of its values, a stored
  ``fingerprint``, the first ``record`` of the key and how many there are.

The hash is built in levels: keys that hash to a bit of their own set it, the
others go to the next level; a key's value is the number of set bits before
its own. Finding a key takes one bit test per level, under two on average.

A task that is run again writes files of another name; the manifest, itself
written by Spark, lists those of the attempt that succeeded.
"""
from __future__ import annotations

import io
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, tokenizing

#: bits per remaining key at each level
GAMMA = 2.0
NULL_KEY = -(1 << 63)


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijective 64-bit mix (splitmix64 finaliser) of keys and seed."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash over distinct int64 keys."""

    def __init__(self, sizes, bits, ranks):
        self.sizes, self.bits, self.ranks = sizes, bits, ranks
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, levels = np.asarray(keys, np.int64), [], []
        while len(left):
            size = max(64, int(GAMMA * len(left)))
            at = (mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        flat = np.concatenate(levels) if levels else np.zeros(0, bool)
        words = np.packbits(np.pad(flat, (0, -len(flat) % 512)), bitorder="little")
        per_block = np.unpackbits(words).reshape(-1, 512).sum(1) if len(words) else np.zeros(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint64)
        return cls(np.array(sizes, np.int64), words, ranks)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Value of each key; -1 for some keys that were not built in (the
        fingerprint tells the others)."""
        keys = np.asarray(keys, np.int64)
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(todo):
                break
            at = (mix(keys[todo], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            hit = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            out[todo[hit]] = self._rank(at[hit])
            todo = todo[~hit]
        return out

    def _rank(self, at: np.ndarray) -> np.ndarray:
        block = at >> 9
        rows = self.bits.reshape(-1, 64)[block]
        inside = np.unpackbits(rows, axis=1, bitorder="little") if len(at) else np.zeros((0, 512), np.uint8)
        before = np.arange(512)[None, :] < (at & 511)[:, None]
        return self.ranks[block].astype(np.int64) + (inside * before).sum(1)


class Shard:
    """An opened shard: ``get(key)`` and ``record(i)``."""

    def __init__(self, ids_path: str, index_path: str):
        with common.open_read(index_path) as f:
            x = np.load(io.BytesIO(f.read()))
            self.keys, self.nulls, self.offsets = x["keys"], x["nulls"], x["offsets"]
            self.hash = PerfectHash(x["sizes"], x["bits"], x["ranks"])
            self.fingerprint, self.first, self.count = x["fingerprint"], x["first"], x["count"]
            self.dtype = np.dtype(str(x["dtype"]))
        self.file = common.open_read(ids_path)

    def locate(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key (0 where absent)."""
        keys = np.asarray(keys, np.int64)
        slot = self.hash.find(keys)
        known = slot >= 0
        slot = np.where(known, slot, 0)
        if not len(self.first):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        known &= self.fingerprint[slot] == fingerprints(keys)
        return self.first[slot], np.where(known, self.count[slot], 0)

    def record(self, i: int) -> np.ndarray:
        a, b = int(self.offsets[i]), int(self.offsets[i + 1])
        self.file.seek(a * self.dtype.itemsize)
        return np.frombuffer(self.file.read((b - a) * self.dtype.itemsize), self.dtype).astype("<u4")

    def get(self, key: int) -> list[np.ndarray]:
        first, n = (int(v[0]) for v in self.locate(np.array([key])))
        return [self.record(i) for i in range(first, first + n)]

    def close(self) -> None:
        self.file.close()


MANIFEST = "shard int, ids_path string, index_path string, docs long, ids long, least long, most long"


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0,
                shards: int | None = None) -> DataFrame:
    """Encode every whole text (null: empty), append ``end_id`` and write the
    shards under ``path``; returns the manifest (one row per shard, read back
    from ``path/manifest``). Keys ascend through the shards; a null key comes
    first; rows that share a key are stored each, next to one another, by the
    hash of their text, so a key of many texts goes over several shards. An
    empty table gives no shards. Executors write with plain file calls (or an
    Arrow file system, for a URI): ``path`` must be shared by all machines."""
    spark = docs.sparkSession
    shards = shards or common.shuffle_parts(spark)
    wide = _vocabulary(tokenizer) > 1 << 16

    def run(batches):
        enc = tokenizing.encoder(tokenizer)
        shard, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        dtype = "<u4" if wide else "<u2"
        ids_path, index_path = (f"{path}/{shard:06d}-{name}.{x}" for x in ("ids", "npz"))
        keys, nulls, sizes = [], [], [0]
        with common.open_write(ids_path) as out:
            for b in batches:
                for k in b.column(0).to_pylist():
                    keys.append(NULL_KEY if k is None else k)
                    nulls.append(k is None)
                texts = b.column(1).to_pylist()
                for lo, hi in tokenizing.together(texts):
                    raw, n = enc.batch(texts[lo:hi])
                    # the end id goes after each text
                    out.write(np.insert(raw.astype(dtype), np.cumsum(n), end_id).tobytes())
                    sizes += (n + 1).tolist()
        if not keys:
            return
        keys = np.array(keys, np.int64)
        offsets = np.cumsum(np.array(sizes, np.int64))
        some, first, count = np.unique(keys, return_index=True, return_counts=True)
        ph = PerfectHash.build(some)
        at = ph.find(some)
        order = np.empty(len(some), np.int64)
        order[at] = np.arange(len(some))
        body = io.BytesIO()
        np.savez(body, keys=keys, nulls=np.array(nulls), offsets=offsets, sizes=ph.sizes, bits=ph.bits,
                 ranks=ph.ranks, fingerprint=fingerprints(some)[order], first=first[order],
                 count=count[order], dtype=np.array(dtype))
        with common.open_write(index_path) as out:
            out.write(body.getvalue())
        yield pa.RecordBatch.from_pylist([{
            "shard": shard, "ids_path": ids_path, "index_path": index_path, "docs": len(keys),
            "ids": int(offsets[-1]), "least": int(keys[0]), "most": int(keys[-1])}],
            schema=pa.schema([("shard", pa.int32()), ("ids_path", pa.string()), ("index_path", pa.string()),
                              ("docs", pa.int64()), ("ids", pa.int64()), ("least", pa.int64()),
                              ("most", pa.int64())]))

    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
               .withColumn("_hash", F.xxhash64("text"))
               .repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), "_hash")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_hash", "text").drop("_hash"))
    common.map_arrow(ordered, run, MANIFEST).write.parquet(f"{path}/manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _vocabulary(tokenizer: str) -> int:
    return tokenizing.Encoder(tokenizer).tok.get_vocab_size(with_added_tokens=True)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document, read back from the files: ``start`` (ids
    of all documents before it in key order), ``n_tokens`` and ``ids`` (binary,
    little-endian uint32). Every document is found by its key through the
    perfect hash, and must be where the sequential order says."""
    manifest = read_manifest(spark, path)
    # one row per shard
    placed = manifest.withColumn(
        "base", F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)))
    placed = placed.select("ids_path", "index_path", F.coalesce("base", F.lit(0)).alias("base"))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                shard = Shard(r["ids_path"], r["index_path"])
                first, count = shard.locate(shard.keys)
                at = np.arange(len(shard.keys))
                if not ((first <= at) & (at < first + count)).all():
                    raise ValueError(f"index of {r['index_path']} does not lead to its keys")
                for lo in range(0, len(at), 256):
                    rows = at[lo:lo + 256].tolist()
                    raw = [shard.record(i).tobytes() for i in rows]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([None if shard.nulls[i] else int(shard.keys[i]) for i in rows], pa.int64()),
                        pa.array([r["base"] + int(shard.offsets[i]) for i in rows], pa.int64()),
                        pa.array([len(x) // 4 for x in raw], pa.int64()),
                        pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                        pa.array(raw, pa.binary())], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                shard.close()

    return (placed.repartition(common.shuffle_parts(spark), "ids_path")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"))


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``ids`` of each row of ``keys`` (column ``doc_id``) by keyed access; a
    key that is stored several times gives several rows, an unknown one none."""
    manifest = read_manifest(spark, path)
    want = keys.select(F.col("doc_id").cast("long"))
    known = want.join(manifest, F.coalesce("doc_id", F.lit(NULL_KEY)).between(F.col("least"), F.col("most")))

    def run(batches):
        shard, at = None, None
        for b in batches:
            paths, index = b.column("ids_path").to_pylist(), b.column("index_path").to_pylist()
            keys = np.array([NULL_KEY if k is None else k for k in b.column("doc_id").to_pylist()], np.int64)
            cuts = [i for i in range(len(paths)) if not i or paths[i] != paths[i - 1]] + [len(paths)]
            for lo, hi in zip(cuts, cuts[1:]):
                if paths[lo] != at:
                    if shard:
                        shard.close()
                    shard, at = Shard(paths[lo], index[lo]), paths[lo]
                first, count = shard.locate(keys[lo:hi])
                hits = [(b.column("doc_id")[i].as_py(), shard.record(r).tobytes())
                        for i, f, n in zip(range(lo, hi), first.tolist(), count.tolist()) for r in range(f, f + n)]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in hits], pa.int64()),
                                                  pa.array([x for _, x in hits], pa.binary())], ["doc_id", "ids"])
        if shard:
            shard.close()

    sorted_ = (known.select("doc_id", "ids_path", "index_path")
               .repartition(common.shuffle_parts(spark), "ids_path").sortWithinPartitions("ids_path"))
    return common.map_arrow(sorted_, run, "doc_id long, ids binary")
