"""Jaccard self-join of word n-gram sets by count-vector R-trees.

A text's set is its distinct n-word shingles, as 64-bit hashes. Its point
counts how many of its shingles fall into each of ``GROUPS`` hash groups: two
sets overlap at most by the sum of the coordinate minima of their points, and
a point and a bounding box at most by the sum of minima with the box's upper
corner, which prunes R-tree nodes. Pairs that survive are verified on the sets.

Which points meet in one tree:

1. Equal sets are one class (64-bit sum of mixed hashes); classes are joined.
2. Classes that can link are brought together without comparing them. Sets of
   sizes a <= b that link differ in at most a/9 shingles at threshold 0.9, a/4
   at 0.8. Cut every set into more blocks than that, by hash: some block is
   equal. So each class emits the sum of hashes of each block, and classes that
   share one are put into one neighbourhood: the connected components of
   "shares a block". With spare blocks several are equal, and a set with fewer
   empty blocks than that has one among them that holds shingles: only a set
   with as many empty blocks emits those too.
   No link crosses neighbourhoods. Keys are combined before they are shuffled,
   within runs of ``KEYS_HELD``: a key ties its classes to the smallest one (a
   star), so a block that a third of all classes share is one key of each run.
   A run's keys travel packed by bucket of the key: each class once in a bucket,
   with the low bytes of its keys there. A bucket is one task's group, of about
   ``BLOCK_KEYS`` keys. Two classes may share blocks in every bucket, so each
   class also travels with marks: hashes of ``MARKS`` of its keys, those of its
   blocks of fewest shingles, which most often outlast a change. Classes with an
   equal mark are tied once, in the mark's bucket; a bucket's keys then add only
   ties between classes that neither marks nor its other keys tie.
3. A neighbourhood of more than ``TILE`` classes, or more than ``HASHES``
   shingles, is cut by its rarest shingles: if every set is put in one order of
   all shingles, the first that two linked sets share is among the first
   n - ceil(threshold * n) + 1 of each. The order is by how many classes of the
   neighbourhood hold a shingle, so the shingles of one class only come first
   and tie nothing, and a passage that many classes share is hardly ever among
   those that count. Classes that share such a shingle are one neighbourhood.
4. Each neighbourhood is indexed and joined. One that is still too large is cut
   by set size into windows of two bands, each class in the two that hold its
   band: sets that link are at most one band apart. A window that is still too
   large is dealt into tiles by hash. Every tile also holds the first tile's
   classes, which ties the tiles together; then only classes outside the main
   component of their neighbourhood go on to the other tiles.

Inside a tree, pairs that are already connected are not verified: the output
is a spanning forest of the links, never all pairs of a group.
"""
from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

GROUPS, LEAF = 64, 128
#: classes of a tile; classes meant for one task of small neighbourhoods
TILE, BUNDLE = 2048, 512
WORDS_HELD, CLASSES_HELD, KEYS_HELD = 100_000, 200_000, 500_000
#: shingles of a tile; block keys of a bucket, shingles of one, and the bytes of
#: a key that are compared within one (equal by chance in a millionth of them: such a tie only
#: makes a neighbourhood larger)
HASHES, BLOCK_KEYS, BUCKET_KEYS, KEY_BYTES = 500_000, 1_000_000, 400_000, 5
#: keys of a class that are its marks; a mark travels as ``KEY_BYTES`` bytes
MARKS = 2
#: a neighbourhood's sizes span this ratio at most per band of block counts
BAND = 1.25


@dataclass(frozen=True)
class Rule:
    """What links: sets of ``shingle`` words with top * intersection >= bottom
    * union. ``spare``: further blocks, as a share of the differing shingles."""

    shingle: int
    top: int
    bottom: int
    spare: float = 0.0

    @property
    def least(self) -> int:
        """Smaller sets only link when equal; larger ones differ in a share of
        1 / least at most."""
        return self.bottom // (self.top - self.bottom)


#: the contract of op6; that of stages on word shingles (blocks of four or five
#: shingles are often empty, those of nine hardly ever)
OP6, STAGE = Rule(3, 100, 90), Rule(5, 100, 80, 0.2)

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of a text; words are hashed once."""

    def __init__(self, rule: Rule = OP6):
        self.shingle = rule.shingle
        self.words: dict[bytes, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        # bytes.lower and bytes.split know A-Z and \x20, \x09-\x0D, no others
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.words
        if len(known) > WORDS_HELD:
            known.clear()
        w = list(map(known.get, words))
        if None in w:
            for i, v in enumerate(w):
                if v is None:
                    w[i] = known[words[i]] = xxhash.xxh64_intdigest(words[i])
        w = np.array(w, np.uint64)
        n = min(self.shingle, len(w))
        h = np.full(len(w) - n + 1, n, np.uint64)
        for i in range(n):
            h = mix(h * _M1 + w[i:len(w) - n + 1 + i] * _M2 + _M3)
        return np.unique(h)


def signed(h) -> np.ndarray:
    return np.asarray(h, np.uint64).view(np.int64)


def set_id(h: np.ndarray) -> int:
    """Identifies a set; 0 only for the empty one."""
    if not len(h):
        return 0
    return int(signed(mix(np.array([mix(h).sum() + np.uint64(len(h))], np.uint64)))[0]) or 1


def band(n: int, rule: Rule = OP6) -> int:
    return int(math.floor(math.log(n / rule.least) / math.log(BAND) + 1e-9))


def blocks(b: int, rule: Rule = OP6) -> tuple[int, int]:
    """Blocks of a set of band ``b``, and how many of them are equal at least
    in two sets that link."""
    differ = math.ceil(rule.least * BAND ** (b + 1)) // rule.least
    equal = 1 + math.ceil(rule.spare * differ)
    return differ + equal, equal


def block_keys(h: np.ndarray, rule: Rule = OP6) -> np.ndarray:
    """Keys of a set's blocks, as the smaller partner (its own band) and as
    the larger one (bands of the sizes it may link with)."""
    return _blocks(h, rule)[0]


def _blocks(h: np.ndarray, rule: Rule = OP6) -> tuple[np.ndarray, np.ndarray]:
    """``block_keys`` and how many shingles each block holds."""
    n, out, held = len(h), [], []
    if n < rule.least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = band(max(rule.least, -(-rule.bottom * n // rule.top)), rule)
    for b in range(low, band(n, rule) + 1):
        m, equal = blocks(b, rule)
        at = ((h >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        starts = np.searchsorted(at[order], np.arange(m))
        sums = np.add.reduceat(np.append(mix(h)[order], np.uint64(0)), np.minimum(starts, n))
        count = np.append(starts[1:], n) - starts
        empty = count == 0
        sums[empty] = 0  # an empty block equals an empty one
        keys = mix(sums * _M1 + np.arange(m, dtype=np.uint64) * _M2 + _M3 + np.uint64(b + 1))
        # if all equal blocks of a pair are empty, both sets have that many
        kept = slice(None) if empty.sum() >= equal else ~empty
        out.append(keys[kept])
        held.append(count[kept])
    return signed(np.concatenate(out)), np.concatenate(held)


def marks(keys: np.ndarray, held: np.ndarray) -> np.ndarray:
    """``MARKS`` marks of a set with these ``_blocks``: which keys they are of
    depends on the keys alone. A set of fewer keys has marks that repeat."""
    k = keys.view(np.uint64)
    # a block without shingles is equal in sets that are not alike
    least = np.lexsort((k, np.where(held == 0, len(k) + held.max(initial=0), held)))[:MARKS]
    return np.resize(k[least] >> np.uint64(64 - 8 * KEY_BYTES), MARKS)


def count_keys(n: int, rule: Rule = OP6) -> int:
    """At least as many as ``block_keys`` of a set of ``n``."""
    if n < rule.least:
        return 0
    low = band(max(rule.least, -(-rule.bottom * n // rule.top)), rule)
    return sum(blocks(b, rule)[0] for b in range(low, band(n, rule) + 1))


#: what tells rows apart: their key (0 and ``keyless`` for none) and a hash of the text
ROW = ["key0", "keyless", "text_hash"]


def _row(docs: DataFrame) -> list:
    key = F.col("doc_id").cast("long")
    return [F.coalesce(key, F.lit(0).cast("long")).alias(ROW[0]), key.isNull().alias(ROW[1]),
            F.xxhash64(F.col("text").cast("string")).alias(ROW[2])]


def sets_of(docs: DataFrame, rule: Rule = OP6) -> DataFrame:
    """(doc_id, n_shingles, set_id, n_keys, text_hash) of every row."""

    def run(batches):
        shingler = Shingler(rule)
        for b in batches:
            n, ids = [], []
            for t in b.column(1):
                h = shingler.hashes(t.as_py())
                n.append(len(h))
                ids.append(set_id(h))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.int64()),
                pa.array([count_keys(x, rule) for x in n], pa.int64()), b.column(2)],
                ["doc_id", "n_shingles", "set_id", "n_keys", "text_hash"])

    text = F.col("text").cast("string")
    return common.map_arrow(docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(text)), run,
                            "doc_id long, n_shingles long, set_id long, n_keys long, text_hash long")


def _tied(keys: np.ndarray, classes: np.ndarray):
    """Keys in order, each with its smallest class, and the pairs that tie its
    other classes to that."""
    order = np.lexsort((classes, keys))
    k, s = keys[order], classes[order]
    first = np.append(True, k[1:] != k[:-1])[:len(k)]
    head = s[np.flatnonzero(first)][np.cumsum(first) - 1]
    other = s != head
    return k[first], s[first], np.unique(np.stack([s[other], head[other]], 1), axis=0)


def _spanning(ties: np.ndarray, ids: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Those of ``ties`` that connect what neither marks nor ties before them
    do. ``marked``: the marks of the classes ``ids``, which are in order."""
    of = marked[np.searchsorted(ids, ties)]  # tie, end, mark
    ties = ties[~(of[:, 0, :, None] == of[:, 1, None, :]).any((1, 2))]
    up: dict = {}

    def root(x):
        top = x
        while (above := up.setdefault(top, top)) != top:
            top = above
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    nodes = np.unique(ties)
    for node, own in zip(nodes.tolist(), marked[np.searchsorted(ids, nodes)].tolist()):
        for m in own:
            up[root(("mark", m))] = root(node)
    new = []
    for a, b in ties.tolist():
        x, y = root(a), root(b)
        up[x] = y
        new.append(x != y)
    return ties[np.array(new, bool)]


def _packed(keys: np.ndarray, classes: np.ndarray, buckets: int, ids: np.ndarray | None = None,
            marked: np.ndarray | None = None):
    """(bucket, bytes): the bucket's classes, how many keys each has, the marks
    of each (``marked``, of the classes ``ids`` in order, if given), and the
    keys' low bytes. A bucket is a range of the keys' high halves."""
    at = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((classes, at))
    at, keys, classes = at[order], keys[order], classes[order]
    low = _short(keys)
    cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1])[:len(at)]).tolist() + [len(at)]
    for lo, hi in zip(cuts, cuts[1:]):
        own, sizes = np.unique(classes[lo:hi], return_counts=True)
        of_own = b"" if marked is None else _short(marked[np.searchsorted(ids, own)].ravel()).tobytes()
        yield int(at[lo]), b"".join([np.int64(len(own)).tobytes(), own.tobytes(), sizes.astype(np.int32).tobytes(),
                                     of_own, low[lo:hi].tobytes()])


def _short(values: np.ndarray) -> np.ndarray:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]


def _wide(data: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = data.reshape(-1, KEY_BYTES)
    return wide.view("<u8").ravel()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    return _parts(data, 0)[:2]


def _parts(data: bytes, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys and their classes; the classes, and the ``count`` marks of each."""
    n = int(np.frombuffer(data, np.int64, 1)[0])
    own, sizes = np.frombuffer(data, np.int64, n, 8), np.frombuffer(data, np.int32, n, 8 + 8 * n)
    rest = np.frombuffer(data, np.uint8, offset=8 + 12 * n)
    cut = n * count * KEY_BYTES
    return _wide(rest[cut:]), np.repeat(own, sizes), own, _wide(rest[:cut]).reshape(n, count)


def neighbourhoods(docs: DataFrame, n_keys: int, rule: Rule = OP6) -> DataFrame:
    """(node, label): classes that share a block, directly or through others.
    ``n_keys``: about how many block keys there are."""
    buckets = min(1 << 30, max(1, -(-n_keys // BLOCK_KEYS)))

    def emit(batches):
        shingler, given, runs = Shingler(rule), {}, 0
        ids: list[int] = []
        keys: list[np.ndarray] = []
        marked: list[np.ndarray] = []

        def run():
            own, at = np.unique(np.array(ids, np.int64), return_index=True)
            of_own = np.stack(marked)[at]
            k = np.concatenate(keys).view(np.uint64)
            s = np.repeat(np.array(ids, np.int64), [len(x) for x in keys])
            for x in (ids, keys, marked):
                x.clear()
            k, s, ties = _tied(k, s)
            mk, ms, mark_ties = _tied(mix(of_own.ravel()), np.repeat(own, MARKS))
            ties = np.concatenate([mark_ties, _spanning(ties, own, of_own)])
            by_mark, by_key = list(_packed(mk, ms, buckets)), list(_packed(k, s, buckets, own, of_own))
            places = [x for x, _ in by_mark] + [x for x, _ in by_key] + [runs % buckets]
            none = [None] * len(places)
            yield pa.RecordBatch.from_arrays([
                pa.array(places, pa.int32()),
                pa.array(([x for _, x in by_mark] + none)[:len(places)], pa.binary()),
                pa.array(([None] * len(by_mark) + [x for _, x in by_key] + [None]), pa.binary()),
                pa.array(none[:-1] + [ties.tobytes()], pa.binary())], ["bucket", "marks", "keys", "ties"])

        held = 0
        for b in batches:
            for t in b.column(0):
                h = shingler.hashes(t.as_py())
                s = set_id(h)
                if s in given:
                    continue
                if len(given) > CLASSES_HELD:
                    given.clear()
                given[s] = True
                of_blocks = _blocks(h, rule)
                if not len(of_blocks[0]):
                    continue
                ids.append(s)
                keys.append(of_blocks[0])
                marked.append(marks(*of_blocks))
                held += len(keys[-1])
                if held > KEYS_HELD:
                    yield from run()
                    held, runs = 0, runs + 1
        if held:
            yield from run()

    def join(table):
        ties = [np.frombuffer(x.as_py(), np.int64).reshape(-1, 2) for x in table.column("ties") if x.is_valid]
        for name, count in (("marks", 0), ("keys", MARKS)):
            rows = [_parts(x.as_py(), count) for x in table.column(name) if x.is_valid]
            if rows:
                keys, classes, own, of_own = map(np.concatenate, zip(*rows))
                new = _tied(keys, classes)[2]
                if count:
                    own, at = np.unique(own, return_index=True)
                    new = _spanning(new, own, of_own[at])
                ties.append(new)
        links = np.concatenate(ties) if ties else np.zeros((0, 2), np.int64)
        return pa.table({"a": pa.array(links[:, 0], pa.int64()), "b": pa.array(links[:, 1], pa.int64())})

    rows = common.map_arrow(docs.select(F.col("text").cast("string")), emit,
                            "bucket int, marks binary, keys binary, ties binary")
    return components(rows.groupBy("bucket").applyInArrow(join, "a long, b long").where(F.col("a") != F.col("b")))


def _bundled(keys: np.ndarray, classes: np.ndarray, bundles: int):
    """(bundle, bytes): the keys that several classes hold, with their class and
    how many hold them, by bundle of the class."""
    _, at, count = np.unique(keys, return_inverse=True, return_counts=True)
    held = count[at]
    keys, classes, held = keys[held > 1], classes[held > 1], held[held > 1]
    to = classes % bundles
    order = np.argsort(to, kind="stable")
    to = to[order]
    cuts = np.flatnonzero(np.append(True, to[1:] != to[:-1])[:len(to)]).tolist() + [len(to)]
    for lo, hi in zip(cuts, cuts[1:]):
        rows = order[lo:hi]
        yield int(to[lo]), np.stack([classes[rows], keys[rows], held[rows]]).tobytes()


def _rarest(classes: np.ndarray, keys: np.ndarray, held: np.ndarray, ids: np.ndarray, sizes: np.ndarray,
            rule: Rule = OP6) -> tuple[np.ndarray, np.ndarray]:
    """(keys, classes) of those shared shingles that are among the first of
    their set. ``ids``, ``sizes``: the classes and how many shingles they have."""
    order = np.lexsort((keys, held, classes))
    keys, classes = keys[order], classes[order]
    own, start, count = np.unique(classes, return_index=True, return_counts=True)
    by_id = np.argsort(ids, kind="stable")
    n = sizes[by_id][np.searchsorted(ids[by_id], own)]
    # those that are the class's alone come before
    left = n - -(-rule.bottom * n // rule.top) + 1 - (n - count)
    first = np.arange(len(classes)) - np.repeat(start, count) < np.repeat(left, count)
    return keys[first], classes[first]


def finer(members: DataFrame, n_hashes: int, rule: Rule = OP6) -> DataFrame:
    """(node, label): classes of ``members`` (node, label, n, text) that share
    one of their rarest shingles with another of their label, directly or
    through others; the rest links with nothing. ``n_hashes``: the sum of n."""
    buckets = min(1 << 22, max(1, -(-n_hashes // BUCKET_KEYS)))

    def emit(batches):
        shingler = Shingler(rule)
        ids: list[int] = []
        keys: list[np.ndarray] = []

        def run():
            k, s = np.concatenate(keys), np.repeat(np.array(ids, np.int64), [len(x) for x in keys])
            ids.clear()
            keys.clear()
            rows = list(_packed(k, s, buckets))
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int32()),
                                               pa.array([x for _, x in rows], pa.binary())], ["bucket", "keys"])

        held = 0
        for b in batches:
            labels = np.array(b.column(1).to_pylist(), np.int64).view(np.uint64)
            for node, label, t in zip(b.column(0).to_pylist(), labels, b.column(2)):
                ids.append(node)
                keys.append(mix(shingler.hashes(t.as_py()) ^ mix(np.array([label]))))  # a label's own shingles
                held += len(keys[-1])
                if held > KEYS_HELD:
                    yield run()
                    held = 0
        if held:
            yield run()

    def share(key, table):
        rows = [_unpacked(x.as_py()) for x in table.column("keys")]
        keys = np.concatenate([k for k, _ in rows]).astype(np.int64) | np.int64(key[0].as_py() << 8 * KEY_BYTES)
        rows = list(_bundled(keys, np.concatenate([s for _, s in rows]), buckets))
        return pa.table({"bundle": pa.array([x for x, _ in rows], pa.int64()),
                         "shared": pa.array([x for _, x in rows], pa.binary())})

    def choose(table):
        some = [np.frombuffer(x.as_py(), np.int64).reshape(3, -1) for x in table.column("shared") if x.is_valid]
        classes, keys, held = np.concatenate(some, 1) if some else np.zeros((3, 0), np.int64)
        sized = table.filter(table.column("node").is_valid())
        keys, classes = _rarest(classes, keys, held, np.array(sized.column("node").to_pylist(), np.int64),
                                np.array(sized.column("n").to_pylist(), np.int64), rule)
        return pa.table({"key": pa.array(keys, pa.int64()), "node": pa.array(classes, pa.int64())})

    shared = (common.map_arrow(members.select("node", "label", "text"), emit, "bucket int, keys binary")
              .groupBy("bucket").applyInArrow(share, "bundle long, shared binary"))
    sizes = members.select(F.pmod("node", F.lit(buckets)).alias("bundle"), "node", "n")
    rare = common.written(shared.unionByName(sizes, allowMissingColumns=True).groupBy("bundle")
                          .applyInArrow(choose, "key long, node long"), "rare")
    common.release_shuffles(members.sparkSession)
    least = rare.groupBy("key").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("of")).where(F.col("of") > 1)
    out = components(rare.join(least, "key").select(F.col("node").alias("a"), F.col("low").alias("b"))
                     .where(F.col("a") != F.col("b")).distinct())
    common.forget(rare)
    return out


class RTree:
    """Bulk-loaded R-tree over count vectors: nodes are split at the median of
    the widest coordinate (the set's size counts as one) down to ``LEAF``
    points, and keep the upper corner of their box and their smallest size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        wide = np.hstack([points, sizes[:, None]])
        todo, self.nodes = [np.arange(len(points))], []
        upper, least, most, kids = [], [], [], []
        parent = [-1]
        at = 0
        while at < len(todo):
            rows = todo[at]
            upper.append(points[rows].max(0))
            least.append(int(sizes[rows].min()))
            most.append(int(sizes[rows].max()))
            kids.append([])
            if parent[at] >= 0:
                kids[parent[at]].append(at)
            if len(rows) > LEAF:
                spread = wide[rows].max(0) - wide[rows].min(0)
                order = rows[np.argsort(wide[rows, int(spread.argmax())], kind="stable")]
                todo += [order[:len(order) // 2], order[len(order) // 2:]]
                parent += [at, at]
                self.nodes.append(None)
            else:
                self.nodes.append(rows)
            at += 1
        self.upper, self.least, self.most, self.kids = np.array(upper), np.array(least), np.array(most), kids

    def near(self, point: np.ndarray, size: int, rule: Rule = OP6, least: int = 0) -> np.ndarray:
        """Points of a size of ``least`` or more whose overlap bound reaches
        the threshold."""
        top, bottom = rule.top, rule.bottom
        out, todo = [], np.array([0])
        while len(todo):
            # sizes first: they are read much faster than corners
            small, large = self.least[todo], self.most[todo]
            todo = todo[(large >= least) & (top * np.minimum(size, large) >= bottom * np.maximum(size, small))]
            # o >= q * (a + b - o), at the node's smallest size
            bound = np.minimum(self.upper[todo], point).sum(1, dtype=np.int64)
            todo = todo[bound * (top + bottom) >= bottom * (size + self.least[todo])].tolist()
            out += [self.nodes[i] for i in todo if self.nodes[i] is not None]
            todo = np.array([k for i in todo for k in self.kids[i]], np.int64)
        if not out:
            return np.zeros(0, np.int64)
        rows = np.concatenate(out)
        other = self.sizes[rows]
        rows = rows[(other >= least) & (top * np.minimum(size, other) >= bottom * np.maximum(size, other))]
        bound = np.minimum(self.points[rows], point).sum(1, dtype=np.int64)
        return np.sort(rows[bound * (top + bottom) >= bottom * (size + self.sizes[rows])])


class Postings:
    """Which of a tile's sets hold each shingle: the exact overlaps of one set
    with all others. Shingles of one set only, which most are, cost nothing."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.append(True, every[1:] != every[:-1])
        count = np.diff(np.append(np.flatnonzero(first), len(every)))
        shared = np.repeat(count > 1, count)
        self.owner = owner[order][shared]
        count = count[count > 1]
        self.start, self.count = np.cumsum(count) - count, count
        code = np.full(len(every), -1)
        code[order[shared]] = np.repeat(np.arange(len(count)), count)
        self.code = np.split(code, np.cumsum(sizes)[:-1])
        self.n = len(sets)

    def overlaps(self, i: int) -> np.ndarray:
        code = self.code[i]
        code = code[code >= 0]
        count = self.count[code]
        ends = np.cumsum(count)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[code] - (ends - count), count)
        return np.bincount(self.owner[at], minlength=self.n)


def linked(a: np.ndarray, b: np.ndarray, rule: Rule = OP6) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    o = int((both[1:] == both[:-1]).sum())
    return rule.top * o >= rule.bottom * (len(a) + len(b) - o)


def join_tile(ids: np.ndarray, sets: list[np.ndarray], probe: np.ndarray, group: np.ndarray,
              rule: Rule = OP6) -> list[tuple[int, int]]:
    """Spanning links among one tile's sets. ``probe``: which ones ask the tree
    (all of which are indexed); ``group``: those of equal group are connected
    already (-1: none). Connected sets are given as stars."""
    n = len(ids)
    if n < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    points = np.stack([np.bincount((s & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS) for s in sets])
    if points.max() < 1 << 15:
        points = points.astype(np.int16)
    every = bool(probe.all())  # then a pair is found by its smaller set
    tree = RTree(points, sizes)
    held = Postings(sets, sizes)
    tied = np.arange(n)  # equal for sets that are connected
    seen: dict[int, int] = {}
    for i, g in enumerate(group.tolist()):
        if g != -1 and seen.setdefault(g, i) != i:
            tied[i] = seen[g]
    for i in np.flatnonzero(probe).tolist():
        near = tree.near(points[i], int(sizes[i]), rule, int(sizes[i]) if every else 0)
        near = near[tied[near] != tied[i]]
        if len(near):
            o = held.overlaps(i)[near]
            near = near[rule.top * o >= rule.bottom * (sizes[i] + sizes[near] - o)]
            if len(near):
                tied[np.isin(tied, tied[near])] = tied[i]
    # as stars: every set to the smallest of its group
    order = np.lexsort((ids, tied))
    first = np.append(True, tied[order][1:] != tied[order][:-1])
    least = ids[order][np.flatnonzero(first)][np.cumsum(first) - 1]
    return [(int(a), int(b)) for a, b in zip(ids[order], least) if a != b]


def _tiles(members: DataFrame, rule: Rule) -> DataFrame:
    """Join every (bundle, place, tile) group of members (set_id, text,
    probe, known) and return the links (a, b). Texts are smaller than their
    hashes, so those are made where they are compared."""

    def run(table):
        links = []
        place = np.array(table.column("place").to_pylist(), np.int64)
        ids = np.array(table.column("set_id").to_pylist(), np.int64)
        probe = np.array(table.column("probe").to_pylist(), bool)
        known = np.array(table.column("known").to_pylist(), np.int64)
        shingler = Shingler(rule)
        sets = [shingler.hashes(t.as_py()) for t in table.column("text")]
        order = np.lexsort((ids, place))
        cuts = np.flatnonzero(np.append(True, place[order][1:] != place[order][:-1])).tolist() + [len(order)]
        for lo, hi in zip(cuts, cuts[1:]):
            rows = order[lo:hi]
            links += join_tile(ids[rows], [sets[r] for r in rows], probe[rows], known[rows], rule)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                         "b": pa.array([y for _, y in links], pa.int64())})

    return members.groupBy("bundle", "tile").applyInArrow(run, "a long, b long")


def _sized(rows: DataFrame) -> DataFrame:
    """Adds how many ``tiles`` each row's ``label`` needs."""
    sizes = rows.groupBy("label").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(TILE)), F.ceil(F.sum("n") / F.lit(HASHES))).alias("tiles"))
    return rows.join(sizes, "label")


def links(docs: DataFrame, sets: DataFrame, rule: Rule = OP6) -> list[DataFrame]:
    """Stored tables (a, b): links between classes that connect what the join
    connects."""
    near = neighbourhoods(docs, sets.agg(F.coalesce(F.sum("n_keys"), F.lit(0))).first()[0], rule)
    # the text of each class: that of one row, by key and text
    least = F.min(F.struct(F.col("doc_id").isNull().alias(ROW[1]),
                           F.coalesce("doc_id", F.lit(0).cast("long")).alias(ROW[0]), F.col(ROW[2])))
    picked = sets.groupBy("set_id").agg(least.alias("row"), F.max("n_shingles").alias("n"))
    placed = common.written(near.join(picked, near["node"] == picked["set_id"])
                            .select("node", "label", "n", "row.*"), "placed")
    common.forget(near)
    common.release_shuffles(docs.sparkSession)  # the keys'
    total = placed.agg(F.count(F.lit(1)).alias("size"), F.coalesce(F.sum("n"), F.lit(0)).alias("weight")).first()
    small = max(1, -(-total["size"] // BUNDLE), -(-total["weight"] // HASHES))
    bundle = F.pmod(F.xxhash64("label"), F.lit(small))
    # rows that repeat are one before they meet, so a class has one row
    texts = docs.select(F.col("text").cast("string"), *_row(docs)).groupBy(*ROW).agg(F.min("text").alias("text"))
    stored = common.written(
        texts.join(_sized(placed), ROW).select("text", "node", "label", "n", "tiles"), "members")
    common.forget(placed)
    common.release_shuffles(docs.sparkSession)  # the texts'
    kept = [stored]
    members = stored.where(F.col("tiles") == 1).select(
        F.col("node").alias("set_id"), F.col("label").alias("place"), "tiles", F.lit(0).cast("long").alias("home"),
        bundle.alias("bundle"), "text")
    large = stored.where(F.col("tiles") > 1)
    weight = large.agg(F.sum("n")).first()[0]
    if weight:
        label = finer(large, weight, rule)
        # windows of two bands of sizes; a band is a little wider than sizes that
        # link are apart, so rounding cannot put them further
        step = math.log(rule.top / rule.bottom) * 1.001
        band_of = F.floor(F.log(F.col("n").cast("double")) / F.lit(step))
        windows = _sized(large.select("node", "n").join(label, "node")).select("*", F.explode(F.when(
            F.col("tiles") > 1, F.array(band_of - 1, band_of)).otherwise(F.array(F.lit(None).cast("long")))).alias("window"))
        windows = windows.select("node", "n", F.when(F.col("window").isNull(), F.col("label"))
                                 .otherwise(F.xxhash64("label", "window")).alias("label"))
        chosen = (_sized(windows)
                  .withColumn("home", F.when(F.col("tiles") > 1, F.pmod(F.xxhash64("node"), F.col("tiles")))
                              .otherwise(F.lit(0)).cast("long"))
                  .withColumn("bundle", F.when(F.col("tiles") > 1, F.col("label")).otherwise(bundle))
                  .select("node", F.col("label").alias("place"), "tiles", "home", "bundle"))
        dealt = common.written(large.select("node", "text").join(chosen, "node").select(
            F.col("node").alias("set_id"), "place", "tiles", "home", "bundle", "text"), "members")
        common.forget(label)
        common.release_shuffles(docs.sparkSession)
        kept.append(dealt)
        members = members.unionByName(dealt)
    everywhere = F.when((F.col("tiles") > 1) & (F.col("home") == 0),
                        F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).otherwise(F.array("home"))
    first = members.select("*", F.explode(everywhere).alias("tile"), F.lit(True).alias("probe"),
                           F.lit(-1).cast("long").alias("known"))
    found = common.written(_tiles(first, rule), "tile-links")
    common.release_shuffles(docs.sparkSession)  # the members'
    wide = dealt.where(F.col("tiles") > 1) if weight else None
    if wide is None or wide.isEmpty():
        common.forget(*kept)
        return [found]
    # neighbourhoods of several tiles: classes outside the main component
    inside = components(found)
    part = common.written(
        wide.join(inside.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("known", F.coalesce("label", "set_id")).drop("label"), "parts")
    common.forget(*kept, inside)
    common.release_shuffles(docs.sparkSession)
    weight = part.groupBy("place", "known").agg(F.count(F.lit(1)).alias("n"))
    main = weight.groupBy("place").agg(F.max_by("known", F.struct("n", "known")).alias("main"))
    whole = part.join(main, "place")
    outside = F.col("known") != F.col("main")
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1),
                      lambda t: (t != F.col("home")) & (F.col("home") != 0))
    asks = whole.where(outside).select("*", F.explode(others).alias("tile"), F.lit(True).alias("probe"))
    stays = whole.select("*", F.col("home").alias("tile"), F.lit(False).alias("probe"))
    again = common.written(_tiles(asks.unionByName(stays).drop("main"), rule), "tile-links")
    common.forget(part)
    common.release_shuffles(docs.sparkSession)
    return [found, again]


def _grouped(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """The rows' sets, and (set_id, label, component_id) of every class."""
    sets = common.written(sets_of(docs, rule), "sets")
    found = links(docs, sets, rule)
    label = components(reduce(DataFrame.unionByName, found))
    common.forget(*found)
    classes = sets.where(F.col("set_id") != 0).groupBy("set_id").agg(F.min("doc_id").alias("least"))
    classes = common.written(
        classes.join(label.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("label", F.coalesce("label", "set_id")), "classes")
    common.forget(label)
    least = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    return sets, classes.join(least, "label").select("set_id", "label", "component_id")


def near_duplicates(docs: DataFrame, rule: Rule = OP6) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``:
    ``component_id`` is the smallest key reachable over links, the row's own
    included. A null text, and one without words, links with nothing; equal
    non-empty sets always link; a row without key gets its component's
    smallest key, null when there is none."""
    sets, of_class = _grouped(docs, rule)
    return (sets.select("doc_id", "n_shingles", "set_id").join(of_class.drop("label"), "set_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, rule: Rule = STAGE) -> DataFrame:
    """One row of each component, all columns: of its smallest key (a row
    without key only where no row has one), and of that key's texts in the
    component the one of smallest hash. Rows without words are all kept."""
    sets, of_class = _grouped(docs, rule)
    worded = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    first = F.min(F.struct(F.col("doc_id").isNull().alias(ROW[1]), F.coalesce("doc_id", F.lit(0).cast("long")).alias(ROW[0]),
                           F.col(ROW[2])))
    chosen = sets.join(of_class, "set_id").groupBy("label").agg(first.alias("row")).select("row.*")
    names = [f"_near_{c}" for c in ROW]  # docs may have columns of these names
    rows = (docs.where(worded).select("*", *[c.alias(n) for c, n in zip(_row(docs), names)]).dropDuplicates(names)
            .join(chosen.select(*[F.col(c).alias(n) for c, n in zip(ROW, names)]), names, "left_semi"))
    return rows.select(*docs.columns).unionByName(docs.where(~worded))
