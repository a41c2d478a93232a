"""Byte-level BPE with Spark higher-order functions.

The merges run in the JVM: a distinct word is an array of the ids of its bytes,
and a fold over it joins, at each step, the neighbours whose joined bytes have
the smallest rank in a literal rank map. The map is a hash table of the pairs of
tokens that join to a token: two array reads and no comparison a look-up (a map
literal would be searched from end to end).

The map is a constant row that a scalar subquery brings into the fold: as a
literal in the plan, its 190,000 numbers were printed into each description of
the plan that the driver keeps.

Words that are a token need no fold. Frequent words are folded once, and their
ids broadcast (at most ``TABLE`` words of at most ``LONGEST`` bytes, chosen on a
sample of ``SAMPLE`` bytes of text; no result depends on which they are); each
document's other distinct words are folded beside it, without a shuffle. Words
are the matches of the split pattern; cutting texts into them and joining ids is
done on Arrow batches. A match of more than ``LONGEST`` bytes has no bound on its
length, and the fold is quadratic, so the rank file's own library encodes it.

Decoding concatenates the binary pieces of the ids.
"""
from __future__ import annotations

import base64
import functools
import math
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, token_counts, tokenizing

TABLE, LONGEST, HELD, CACHE = 500_000, 48, 50_000, 20_000
#: characters of texts that are cut together
TOGETHER = 1 << 20
#: rows whose ids are filled in and decoded together
ROWS = 250
#: bytes of text that the frequent words are chosen on
SAMPLE = 128 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


#: a rank and an id have this many bits
BITS = 17
_EMPTY = ((1 << BITS) - 1) << 2 * BITS  # a slot of no pair


def merges(ranks: dict[bytes, int]) -> np.ndarray:
    """(left, right, joined): ids of all pairs of tokens whose bytes joined are
    a token."""
    return np.array([(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items()
                     for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks], np.int64).reshape(-1, 3)


def rank_slots(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, int]:
    """A hash table without collisions: the slot of a pair is its number modulo
    a third value, plus the displacement of its group (its number modulo the
    count of displacements). A slot holds left, right and rank, of ``BITS``
    bits each."""
    pairs = merges(ranks)
    number = (pairs[:, 0] << BITS) + pairs[:, 1]
    groups, modulus = len(pairs) // 3 | 1, 5 * len(pairs) // 4 + 1
    while True:  # no two pairs of a group in one slot
        group, slot = number % groups, number % modulus
        if len(np.unique(group * modulus + slot)) == len(pairs):
            break
        modulus += 1
    count = np.bincount(group, minlength=groups)
    order = np.lexsort((group, -count[group]))
    shift, taken = np.zeros(groups, np.int64), bytearray(4 * modulus)
    cuts = np.flatnonzero(np.append(True, np.diff(group[order]) != 0)[:len(order)]).tolist() + [len(order)]
    for lo, hi in zip(cuts, cuts[1:]):
        own = slot[order[lo:hi]].tolist()
        d = 0
        while any(taken[s + d] for s in own):
            d += 1
        for s in own:
            taken[s + d] = 1
        shift[group[order[lo]]] = d
    slot += shift[group]
    slots = np.full(int(slot.max(initial=-1)) + 1, _EMPTY)
    slots[slot] = (number << BITS) + pairs[:, 2]
    return shift, slots, modulus


#: bits of a place in a word, its two ends included; a neighbour of this rank does not join
PLACE = (LONGEST + 2).bit_length()
_APART = (1 << BITS) - 1


class RankMap:
    """The literal rank map as Spark columns: a constant row, of which plans
    hold (and print) a reference only."""

    def __init__(self, spark, path: str):
        ranks = read_ranks(path)
        shift, slots, self.modulus = rank_slots(ranks)
        self.groups, self.end = len(shift), max(ranks.values()) + 1  # an id that is in no pair
        bytes_ = [ranks[bytes([i])] for i in range(256)]
        self.row = spark.createDataFrame(pa.table({
            "shift": pa.array([shift], pa.list_(pa.int32())), "slots": pa.array([slots], pa.list_(pa.int64())),
            "bytes": pa.array([bytes_], pa.list_(pa.int64()))})).select(F.struct("shift", "slots", "bytes"))

    def encode(self, rows: DataFrame, words: str) -> DataFrame:
        """Adds ``ids``: those of each of ``words``, an array of binary words of
        at most ``LONGEST`` bytes, by merges alone. The tables are named once."""
        return rows.select("*", self.row.scalar().alias("_ranks")).select(*rows.columns, let(
            F.col("_ranks"), lambda t: F.transform(words, Ranks(t, self.groups, self.modulus, self.end).encode)).alias("ids"))


class Ranks:
    """Look-ups and merges by the tables that a column holds."""

    def __init__(self, tables: Column, groups: int, modulus: int, end: int):
        self.shift, self.slots, self.bytes = tables["shift"], tables["slots"], tables["bytes"]
        self.groups, self.modulus, self.end = (F.lit(x).cast("long") for x in (groups, modulus, end))

    def rank(self, a: Column, b: Column) -> Column:
        """Rank of two ids joined; ``_APART`` when they are no token (the slot
        then holds another pair, or is none)."""
        pair = F.shiftleft(a, BITS) + b
        slot = F.get(self.shift, (pair % self.groups).cast("int")) + pair % self.modulus
        return F.least(F.get(self.slots, slot.cast("int")).bitwiseXOR(F.shiftleft(pair, BITS)), number(_APART))

    def encode(self, word: Column) -> Column:
        """The fold of ranked merges over the word's bytes, between two ends
        that join nothing. Its state is one array of numbers: the rank of an id
        joined with the next one, the place of its first byte, and the id. The
        least of them is the smallest rank, the leftmost of equals; a merge
        changes the ranks of two."""

        def step(state, _):
            def merge(least):
                def at(p):  # from 1; never an end
                    before, new = F.get(state, p - 2), F.shiftright(least, PLACE + BITS)
                    return joined(
                        F.slice(state, F.lit(1), p - 2),
                        F.array(F.shiftleft(self.rank(_id(before), new), PLACE + BITS)
                                + before.bitwiseAND(number((1 << PLACE + BITS) - 1)),
                                F.shiftleft(self.rank(new, _id(F.get(state, p + 1))), PLACE + BITS)
                                + least.bitwiseAND(number((1 << PLACE) - 1 << BITS)) + new),
                        F.slice(state, p + 2, F.size(state)))

                return F.when(least < number(_APART << PLACE + BITS),
                              let(F.array_position(state, least).cast("int"), at)).otherwise(state)

            return let(F.array_min(state), merge)

        size = F.octet_length(word)
        single = F.transform(F.split(F.decode(word, "ISO-8859-1"), ""), lambda c: F.get(self.bytes, F.ascii(c)))
        first = let(joined(F.array(self.end), single, F.array(self.end)), lambda s: F.transform(
            s, lambda x, i: F.shiftleft(F.when(i > size, number(_APART)).otherwise(
                self.rank(x, F.get(s, i + 1))), PLACE + BITS) + F.shiftleft(i.cast("long"), BITS) + x))
        return F.aggregate(F.sequence(F.lit(2), size), first, step, lambda s: F.transform(
            F.slice(s, F.lit(2), F.size(s) - 2), _id))


def number(value: int) -> Column:
    return F.lit(value).cast("long")


def _id(x: Column) -> Column:
    return x.bitwiseAND(number((1 << BITS) - 1))


def joined(*parts: Column) -> Column:
    """Arrays joined; ``concat`` takes several times as long on short ones."""
    return F.flatten(F.array(*parts))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Cutter:
    """Matches of the split pattern, piece by piece: a piece that repeats is
    split once."""

    def __init__(self, values):
        import regex
        self.find = regex.compile(tokenizing.BYTE_PATTERN).findall
        # values: lists of matches -> what is kept for each piece
        self.bare = tokenizing.Pieces(lambda ps: values([self.words(p) for p in ps]), CACHE)
        self.spaced = tokenizing.Pieces(lambda ps: values([self.words(tokenizing.spaced(p)) for p in ps]), CACHE)

    def words(self, piece: str) -> list[str]:
        # letters after at most a space are one match
        return [piece] if piece.lstrip(" ").isalpha() and piece.isascii() and "  " not in piece else self.find(piece)

    def __call__(self, texts: list) -> tuple[list, np.ndarray, np.ndarray]:
        """The values of distinct pieces, and their places (see ``numbered_pieces``)."""
        bare, spaced, at, counts = tokenizing.numbered_pieces(
            texts, lambda t: None if tokenizing.is_plain(t) else self.find(t))
        return self.bare.get_all(bare) + self.spaced.get_all(spaced), at, counts


def frequent_words(docs: DataFrame, table: int = TABLE) -> DataFrame:
    """(word, n): at most ``table`` of the most frequent words, counted over
    all texts. A task holds ``HELD`` distinct pieces and passes on their counts
    when they are more; Spark adds them up."""

    def run(batches):
        import regex
        find = regex.compile(tokenizing.BYTE_PATTERN).findall
        pieces: list[Counter] = [Counter(), Counter()]

        def counted():
            held: Counter = Counter()
            for bare, c in enumerate(pieces):
                for p, n in c.items():
                    for w in find(p if bare else tokenizing.spaced(p)):
                        held[w] += n
                c.clear()
            part = [(raw, n) for w, n in held.items() if len(raw := w.encode("utf-8", "surrogatepass")) <= LONGEST]
            held.clear()
            for i in range(0, len(part), 8192):
                some = part[i:i + 8192]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.binary()),
                                                  pa.array([n for _, n in some], pa.int64())], ["word", "n"])

        for b in batches:
            for t in b.column(0):
                for bare, parts in tokenizing.byte_pieces(t.as_py() or "", find):
                    pieces[bare].update(parts)
                if sum(map(len, pieces)) > HELD:
                    yield from counted()
        yield from counted()

    counts = common.map_arrow(docs.select(F.col("text").cast("string")), run, "word binary, n long")
    return common.most_frequent(counts.groupBy("word").agg(F.sum("n").alias("n")), table)


class WordTable:
    """Words and their ids in flat arrays, found by hash and compared."""

    def __init__(self, words: pa.Array, ids: pa.Array):
        hashes = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer()) for w in words), np.uint64, len(words))
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        words, ids = words.take(pa.array(order)), ids.take(pa.array(order))
        self.word_ends = np.cumsum(np.append(0, pc.binary_length(words).to_numpy()))
        self.words = words.buffers()[2].to_pybytes()[:self.word_ends[-1]] if len(words) else b""
        self.id_ends = np.cumsum(np.append(0, ids.value_lengths().to_numpy()))
        self.ids = ids.flatten().to_numpy().astype("<i4").tobytes()

    def find(self, words: list) -> list:
        """Ids of each word, None of one that the table lacks."""
        out: list = [None] * len(words)
        if not len(self.hashes):
            return out
        h = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == h)
        at = at[hit]
        for i, a, b, c, d in zip(hit.tolist(), self.word_ends[at].tolist(), self.word_ends[at + 1].tolist(),
                                 (4 * self.id_ends[at]).tolist(), (4 * self.id_ends[at + 1]).tolist()):
            if self.words[a:b] == words[i]:
                out[i] = self.ids[c:d]
        return out


def _ids(values) -> bytes:
    return array("i", values).tobytes()


def encode(docs: DataFrame, rank_file: str, table: int = TABLE, decoded: bool = False) -> DataFrame:
    """(doc_id, ids): little-endian uint32 ids of every whole text (null:
    empty) by the ranks of ``rank_file``. Rows that repeat are encoded each.
    ``decoded`` adds the column of ``decode`` in the same pass."""
    spark = docs.sparkSession
    ranks = RankMap(spark, rank_file)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    top = (frequent_words(token_counts.sampled(texts, SAMPLE), table).repartition(common.shuffle_parts(spark))
           .select("word", F.array("word").alias("words")))
    top = ranks.encode(top, "words").select("word", F.get("ids", F.lit(0)).cast("array<int>").alias("ids"))
    top = top.toArrow()  # at most `table` rows
    shared = spark.sparkContext.broadcast(WordTable(*(c.combine_chunks() for c in top.columns)))

    def cut_up(batches):
        """Ids of known words; the others by number, as -1, -3, ..., in a list
        of the document's distinct unknown words; long ones apart (-2, ...)."""
        whole = _whole(rank_file)
        known = shared.value

        def values(pieces):
            """The ids of each piece's words, joined; where one is unknown, a
            list of its words' ids (None: unknown) and bytes."""
            raw = [w.encode("utf-8", "surrogatepass") for words in pieces for w in words]
            got = list(map(whole.get, raw))
            lost = [i for i, x in enumerate(got) if x is None]
            found = known.find([raw[i] for i in lost])
            for i, ids in zip(lost, found):
                got[i] = ids
            out, at = [], 0
            for words in pieces:
                some = got[at:at + len(words)]
                out.append([(x, raw[at + i]) for i, x in enumerate(some)] if None in some else b"".join(some))
                at += len(words)
            return out

        cut = Cutter(values)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in tokenizing.together(texts, TOGETHER):
                skeleton, unknown, long_words = [], [], []
                made, at, counts = cut(texts[lo:hi])
                number: tuple[dict, dict] = {}, {}  # of the words unknown here: short, long
                for i, v in enumerate(made):
                    if type(v) is list:
                        out = []
                        for ids, raw in v:
                            if ids is None:
                                longer = len(raw) > LONGEST
                                ids = _ids([-1 - longer - 2 * number[longer].setdefault(raw, len(number[longer]))])
                            out.append(ids)
                        made[i] = b"".join(out)
                raws = [list(n) for n in number]
                ids, sizes = tokenizing.gathered(made, at, counts)
                ids = ids.view("<i4")
                ends = np.cumsum(sizes).tolist()
                for start, end in zip([0, *ends], ends):
                    own = ids[start:end]
                    some, place = np.unique(own[own < 0], return_inverse=True)
                    # numbered anew within the document
                    words: tuple[list, list] = [], []
                    for k, n in enumerate(some.tolist()):
                        longer = n % 2 == 0
                        words[longer].append(raws[longer][(-1 - longer - n) // 2])
                        some[k] = -1 - longer - 2 * (len(words[longer]) - 1)
                    own[own < 0] = some[place]
                    skeleton.append(own.tobytes())
                    unknown.append(words[0])
                    long_words.append(words[1])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], pa.array(skeleton, pa.binary()), pa.array(unknown, pa.list_(pa.binary())),
                     pa.array(long_words, pa.list_(pa.binary()))], ["doc_id", "skeleton", "words", "long_words"])
            pa.default_memory_pool().release_unused()

    rows = common.map_arrow(texts, cut_up, "doc_id long, skeleton binary, words array<binary>, long_words array<binary>")
    folded = ranks.encode(rows, "words").select("doc_id", "skeleton", "ids", "long_words")

    def fill(batches):
        library, piece = None, _pieces(rank_file) if decoded else None
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, len(b), ROWS)):
            out = []
            for skeleton, ids, longer in zip(b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                s = np.frombuffer(skeleton, "<i4")
                holes = np.flatnonzero(s < 0)
                if not len(holes):
                    out.append(skeleton)
                    continue
                if longer and library is None:
                    library = _library(rank_file)
                words = [_ids(x) for x in ids.as_py()]
                more = [_ids(library.encode_single_piece(w)) for w in longer]
                parts, at = [], 0
                for h in holes.tolist():
                    n = int(s[h])
                    parts += [skeleton[4 * at:4 * h], words[(-1 - n) // 2] if n % 2 else more[(-2 - n) // 2]]
                    at = h + 1
                out.append(b"".join(parts) + skeleton[4 * at:])
            made = [b.column(0), pa.array(out, pa.binary())]
            if decoded:
                made.append(_joined_pieces(piece, out))
            yield pa.RecordBatch.from_arrays(made, ["doc_id", "ids", "bytes"][:len(made)])
            pa.default_memory_pool().release_unused()

    return common.map_arrow(folded, fill, "doc_id long, ids binary" + ", bytes binary" * decoded)


def _library(rank_file: str):
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=tokenizing.BYTE_PATTERN, mergeable_ranks=read_ranks(rank_file),
                             special_tokens={})._core_bpe


@functools.cache  # one for a worker process, not one for each task
def _whole(rank_file: str) -> dict[bytes, bytes]:
    """The ids of words that are a token."""
    return {t: _ids([r]) for t, r in read_ranks(rank_file).items()}


@functools.cache
def _pieces(rank_file: str) -> dict[int, bytes]:
    return {i: t for t, i in read_ranks(rank_file).items()}


def _joined_pieces(piece: dict[int, bytes], ids: list) -> pa.Array:
    return pa.array([b"".join(map(piece.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in ids], pa.binary())


def decode(encoded: DataFrame, rank_file: str) -> DataFrame:
    """Adds ``bytes``: the concatenated pieces of ``ids``."""
    columns = [c for c in encoded.columns if c != "bytes"]
    source = encoded.select(*columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields) + ", `bytes` binary"

    def run(batches):
        piece = _pieces(rank_file)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, _joined_pieces(piece, b.column("ids").to_pylist())],
                                             [*b.schema.names, "bytes"])

    return common.map_arrow(source, run, schema)


def digests(docs: DataFrame, rank_file: str) -> DataFrame:
    """Encode, decode, and reduce to counts and SHA-256."""
    both = encode(docs, rank_file, decoded=True)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
