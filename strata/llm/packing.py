"""Best-fit packing of token sequences, after Martello-Toth dominance reduction.

The instance is the histogram of piece lengths: at most ``capacity`` distinct
lengths, whatever the corpus size. The driver decides on that histogram only:

* reduction: for the longest remaining length, a set of pieces that dominates
  every other way to fill its sequence is fixed for good (Martello and Toth,
  Knapsack Problems, 1990, section 8.5): nothing else fits beside it; or the
  largest piece that fits beside it, when it fills the sequence or when no two
  pieces fit there together. All equal sequences are fixed at once.
* what no rule fixes goes best-fit, longest first, into the fullest sequence
  that still has room, again whole classes of equal sequences at a time.

The plan is a list of segments "pieces number a to b of length L go, one each,
to sequences s, s+1, ... at offset o". Pieces find their segment by their
number among the pieces of their length, which is counted in salted groups, so
a length held by a third of all pieces is not one task's work.
"""
from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, tokenizing

CAPACITY = 2048
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
                 with_ids: bool = False) -> DataFrame:
    """Encode ``text`` (null: empty), append ``end_id`` and cut what is longer
    than ``capacity``. ``with_ids`` adds the ids (little-endian uint32)."""
    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")

    def run(batches):
        enc = tokenizing.encoder(tokenizer, byte_level=False)
        end, step = tokenizing.id_bytes([end_id]), capacity * 4
        for b in batches:
            keys, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                raw = b"".join(enc.values(t.as_py() or "")) + end
                for i in range(0, len(raw), step):
                    part = raw[i:i + step]
                    keys.append(k)
                    piece.append(i // step)
                    start.append(i // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    ids.append(part if with_ids else None)
            cols = [pa.array(keys, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return common.map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema)


class _Open:
    """Open sequences by room left: room -> list of [first sequence, count]."""

    def __init__(self):
        self.rooms: list[int] = []
        self.runs: dict[int, list] = defaultdict(list)

    def put(self, room: int, first: int, count: int) -> None:
        if not self.runs[room]:
            insort(self.rooms, room)
        self.runs[room].append((first, count))

    def take(self, need: int):
        """A run of sequences of the smallest room >= need, or None."""
        i = bisect_left(self.rooms, need)
        if i == len(self.rooms):
            return None
        room = self.rooms[i]
        first, count = self.runs[room].pop()
        if not self.runs[room]:
            self.rooms.pop(i)
        return room, first, count


def plan_segments(histogram: dict[int, int], capacity: int = CAPACITY):
    """(segments, sequences). A segment is (length, first piece number, pieces,
    first sequence, offset); ``histogram`` maps length -> pieces, lengths from
    1 to ``capacity``."""
    left = {k: v for k, v in histogram.items() if v > 0}
    lengths = sorted(left)
    given: dict[int, int] = defaultdict(int)
    out, sequence = [], 0

    def place(length, count, first, offset):
        out.append((length, given[length], count, first, offset))
        given[length] += count

    def use(length, count):
        left[length] -= count
        if not left[length]:
            lengths.pop(bisect_left(lengths, length))
            del left[length]

    def others(length):
        """Remaining pieces of ``length`` besides one that is being placed."""
        return left[length] - (length == longest)

    def mate_of(room):
        i = bisect_left(lengths, room + 1) - 1
        while i >= 0 and not others(lengths[i]):
            i -= 1
        return lengths[i] if i >= 0 else 0

    def two_smallest():
        two = []
        for length in lengths:
            two += [length] * min(2 - len(two), others(length))
            if len(two) == 2:
                return sum(two)
        return capacity + 1

    for longest in sorted(left, reverse=True):
        while longest in left:
            room = capacity - longest
            mate = mate_of(room)
            if not mate:  # nothing fits beside it
                n = left[longest] if longest > room else 1
                place(longest, n, sequence, 0)
                use(longest, n)
            elif mate == room or two_smallest() > room:
                n = left[longest] // 2 if mate == longest else min(left[longest], left[mate])
                place(longest, n, sequence, 0)
                place(mate, n, sequence, longest)
                use(longest, n)
                use(mate, n)
            else:  # several sets compete: best fit decides below
                break
            sequence += n
    open_ = _Open()
    for length in reversed(lengths):
        count = left[length]
        while count:
            got = open_.take(length)
            room = got[0] if got else capacity
            per = room // length
            need = -(-count // per)
            first, n = got[1:] if got else (sequence, need)
            if n > need:
                open_.put(room, first + need, n - need)
                n = need
            sequence += 0 if got else n
            here = min(count, n * per)
            full, part = divmod(here, per)
            for slot in range(per):
                if k := full + (slot < part):
                    place(length, k, first, capacity - room + slot * length)
            for runs, at, filled in ((full, first, per), (part > 0, first + full, part)):
                if runs and (spare := room - filled * length):
                    open_.put(spare, at, int(runs))
            count -= here
    return out, sequence


def assign(pieces: DataFrame, capacity: int = CAPACITY, salts: int | None = None) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``doc_id``, ``piece``,
    ``length`` from 1 to ``capacity``). ``pieces`` must give the same rows each
    time it is read (a written table). Repeated rows are packed one by one;
    an empty table gives an empty result."""
    spark = pieces.sparkSession
    salts = salts or 4 * common.shuffle_parts(spark)
    told_apart = [c for c in ("doc_id", "piece", "ids_crc32") if c in pieces.columns]
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*told_apart), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        "length", "_salt",
        (F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"))
    # at most `capacity` rows reach the driver
    hist = {r["length"]: r["n"] for r in
            pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments, _ = plan_segments(hist, capacity)
    plan = spark.createDataFrame(
        segments, "length long, _first long, _pieces long, _sequence long, offset long")
    number = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*told_apart))
    numbered = (salted.withColumn("_in", number.cast("long") - 1)
                .join(before, ["length", "_salt"])
                .withColumn("_number", F.col("_in") + F.col("_before")))
    hit = ((F.col("_number") >= F.col("_first")) & (F.col("_number") < F.col("_first") + F.col("_pieces")))
    # the plan's size follows the capacity, not the corpus
    return (numbered.alias("p").join(F.broadcast(plan).alias("s"),
                                     (F.col("p.length") == F.col("s.length")) & hit)
            .select("p.*", (F.col("_sequence") + F.col("_number") - F.col("_first")).alias("sequence_id"),
                    F.col("offset"))
            .drop("_salt", "_in", "_before", "_number"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
         with_ids: bool = False) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens."""
    pieces = common.written(token_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    return assign(pieces, capacity)
