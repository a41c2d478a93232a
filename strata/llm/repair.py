"""Repair of conversations by a min-plus dynamic programme over a grammar.

A turn is a symbol: its role's initial (s, u, a, else o), upper case where its
text is cut off, or X where it must go (blank, or said before). Repairing walks
the states of ``(s?(ua)+)?``; a symbol is a 4 x 4 transfer matrix whose entry
(i, j) is the cheapest way from state i to state j over it, insertions before
it included, as a cost and an audit rope (the edits' initials). The product of
two matrices adds costs, joins ropes and keeps the least cost, then the
ASCII-least audit. Audits of the same symbols never continue one another (each
ends with the edit of a turn), so ties may be settled piece by piece.

1. Turns become narrow lines (no text) and are sorted by range, so that a
   conversation of any length is cut into pieces of ``PIECE`` symbols.
2. The distinct pieces are compressed by Re-Pair: pairs of symbols are counted
   over all of them by Spark and the most frequent become rules, round by round.
3. Each rule has one matrix, evaluated bottom-up from those of its two symbols
   on the driver (at most ``ROUNDS * RULES`` rules) and broadcast. Pieces are
   products over few symbols; tasks keep products of words they have seen.
4. One shuffle of whole texts by conversation, pieces first: costs are summed
   from the last piece backwards, edits chosen forwards, and the turns stream
   through them. A hash of a whole conversation is sequential, so one task
   reads it; it holds the compressed pieces, never the turns.

Within a turn number, rows go by role, then by the digest of their text. Nulls:
role and text count as one space, a null turn comes first, rows without conv_id
are one conversation. An empty table gives no rows.
"""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WHITE = " \t\n\x0b\x0c\r"
#: symbols of a piece; rounds of Re-Pair and new rules of a round
PIECE, ROUNDS, RULES = 4096, 8, 16
#: products that a task keeps
WORDS_HELD = 20_000
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
EMPTY_HASH = hashlib.sha256().hexdigest()

#: states: nothing yet, after s, after u, after a; the first and the last may end
STATES = range(4)
_AFTER = {"s": 1, "u": 2, "a": 3}
_MAY = {0: "su", 1: "u", 2: "a", 3: "u"}
#: insertions that lead from one state to another
_INSERTED = {(0, 0): "", (1, 1): "", (2, 2): "", (3, 3): "", (0, 2): "I", (1, 2): "I", (3, 2): "I", (2, 3): "I",
             (0, 3): "II", (1, 3): "II"}
#: cheapest insertions that end a conversation
END = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]

SHAPE = "keyless boolean, key0 long"
KEYS = ["keyless", "key0"]
LINE = ["turned", "turn0", "role", "digest"]


# -- ropes and matrices ------------------------------------------------------

def text_of(rope) -> str:
    """A rope is a string or a pair of ropes."""
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            out.append(r)
        else:
            todo += [r[1], r[0]]
    return "".join(out)


def better(a, b):
    """The lesser of two entries (cost, rope); either may be None."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if text_of(a[1]) <= text_of(b[1]) else b


def times(m, n):
    """Min-plus product with audits."""
    out = []
    for i in STATES:
        row = [None] * 4
        for k in STATES:
            if m[i][k] is None:
                continue
            c, r = m[i][k]
            for j in STATES:
                if n[k][j] is not None:
                    row[j] = better(row[j], (c + n[k][j][0], (r, n[k][j][1]) if n[k][j][1] else r))
        out.append(row)
    return out


def symbol_matrix(symbol: str):
    """Transfer matrix of one turn, insertions before it included."""
    extra = CUT_OFF if symbol.isupper() else 0
    move = [[None] * 4 for _ in STATES]
    for i in STATES:
        move[i][i] = (DELETE, "D")
        if symbol == "X":
            continue
        for initial in _MAY[i]:
            j = _AFTER[initial]
            if symbol.lower() == initial:
                move[i][j] = better(move[i][j], (KEEP + extra, "K"))
            if initial != "s":  # no edit makes a system turn
                move[i][j] = better(move[i][j], (REROLE + extra, "R"))
    insert = [[(INSERT * len(_INSERTED[i, j]), _INSERTED[i, j]) if (i, j) in _INSERTED else None for j in STATES]
              for i in STATES]
    return times(insert, move)


SYMBOLS = "suaoSUAOX"


class Grammar:
    """Rules (symbol, left, right), lower ones first, and their matrices."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.rules = rules
        self.matrix = {s: symbol_matrix(s) for s in SYMBOLS}
        self.spelt = {s: s for s in SYMBOLS}
        for symbol, left, right in rules:
            self.matrix[symbol] = times(self.matrix[left], self.matrix[right])
            self.spelt[symbol] = self.spelt[left] + self.spelt[right]
        self.known: dict[str, list] = {}

    def product(self, word: str):
        found = self.known.get(word)
        if found is None:
            found = self.matrix[word[0]]
            for symbol in word[1:]:
                found = times(found, self.matrix[symbol])
            if len(self.known) >= WORDS_HELD:
                self.known.clear()
            self.known[word] = found
        return found

    def spell(self, word: str) -> str:
        return "".join(self.spelt[s] for s in word)

    def compressed(self, column):
        """``column`` with the rules applied in order, left to right."""
        for symbol, left, right in self.rules:
            column = F.replace(column, F.lit(left + right), F.lit(symbol))
        return column


def re_pair(pieces: DataFrame, column: str = "symbols", rounds: int = ROUNDS, width: int = RULES) -> Grammar:
    """A grammar of the distinct strings of ``pieces``: each round counts all
    pairs of neighbours and makes rules of the most frequent that share no
    symbol, until no pair is found twice. The grammar changes no result."""
    rules: list[tuple[str, str, str]] = []
    with common.temporary(pieces.select(F.col(column).alias("word")).distinct(), "words") as words:
        for _ in range(rounds):
            word = Grammar(rules).compressed(F.col("word"))
            pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1),
                                         lambda at: F.substring(F.col("word"), at, F.lit(2))))
            counts = (words.select(word.alias("word")).where(F.length("word") > 1).select(pair.alias("pair"))
                      .groupBy("pair").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                      .orderBy(F.desc("n"), "pair").limit(4 * width).collect())
            used: set[str] = set()
            fresh = []
            for r in counts:
                left, right = r["pair"]
                if len(fresh) < width and not {left, right} & used:
                    used |= {left, right}
                    fresh.append((chr(0x4E00 + len(rules) + len(fresh)), left, right))
            if not fresh:
                break
            rules += fresh
    return Grammar(rules)


# -- lines and pieces --------------------------------------------------------

def _lines(turns: DataFrame) -> DataFrame:
    """The turns with sort keys; ``digest`` is of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    zero = F.lit(0).cast("long")
    return turns.select(conv.isNull().alias("keyless"), F.coalesce(conv, zero).alias("key0"),
                        turn.isNotNull().alias("turned"), F.coalesce(turn, zero).alias("turn0"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.md5(text.cast("binary")).alias("digest"), text.alias("text"))


def symbol_runs(turns: DataFrame) -> DataFrame:
    """One row for equal turns of a conversation: sort keys and ``symbols``."""
    seen = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    letter = (F.when(seen == "", F.lit("X"))
              .when(F.substring(seen, -1, 1).isin(".", "!", "?"), initial).otherwise(F.upper(initial)))
    lines = common.written(_lines(turns).select(*KEYS, *LINE, letter.alias("letter"))
                           .groupBy(*KEYS, *LINE, "letter").agg(F.count(F.lit(1)).alias("n")), "lines")
    said = [*KEYS, "role", "digest"]
    first = lines.groupBy(*said).agg(F.min(F.struct("turned", "turn0")).alias("first"))
    again = F.struct("turned", "turn0") != F.col("first")
    return lines.join(first, said).select(*KEYS, *LINE, F.concat(
        F.when(again, F.lit("X")).otherwise(F.col("letter")), F.repeat(F.lit("X"), (F.col("n") - 1).cast("int"))).alias("symbols"))


def pieces_of(runs: DataFrame, size: int = PIECE) -> DataFrame:
    """(key, place, symbols): each conversation's symbols in order, cut after
    ``size`` of them and where the sort's partitions end; ``place`` ascends."""

    def run(batches):
        part = TaskContext.get().partitionId() << 32
        no, now, held = 0, None, []
        length = 0
        out: list[tuple] = []

        def cut(whole):
            nonlocal no, held, length
            s = "".join(held)
            end = len(s) if whole else len(s) - len(s) % size
            for lo in range(0, end, size):
                out.append((*now, part + no, s[lo:min(lo + size, end)]))
                no += 1
            held, length = ([s[end:]] if s[end:] else []), len(s) - end

        for b in batches:
            for keyless, key, symbols in zip(*(b.column(c).to_pylist() for c in ("keyless", "key0", "symbols"))):
                if (keyless, key) != now:
                    if held:
                        cut(True)
                    now = (keyless, key)
                held.append(symbols)
                length += len(symbols)
                if length >= size:
                    cut(False)
            yield flat(out)
            out.clear()
        if held:
            cut(True)
        yield flat(out)

    def flat(rows):
        cols = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
            pa.bool_(), pa.int64(), pa.int64(), pa.string()))], ["keyless", "key0", "place", "symbols"])

    order = [*KEYS, *LINE]
    return (runs.repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(run, f"{SHAPE}, place long, symbols string"))


# -- the walk ----------------------------------------------------------------

def choose(products: list) -> tuple[int, list[tuple[int, int]]]:
    """Least cost of a conversation, and each piece's (from, to) states."""
    to_go = [c for c, _ in END]
    tails = []
    for m in reversed(products):
        tails.append(to_go)
        to_go = [min((e[0] + t for e, t in zip(row, to_go) if e is not None), default=None) for row in m]
    at, way = 0, []
    for m, tail in zip(products, reversed(tails)):
        best, to = None, 0
        for j in STATES:
            if m[at][j] is not None:
                here = (m[at][j][0] + tail[j], m[at][j][1])
                if better(best, here) is here:
                    best, to = here, j
        way.append((at, to))
        at = to
    return to_go[0], way


class _Conversation:
    """One conversation's pieces, then its turns in order."""

    def __init__(self, key):
        self.key, self.words, self.plan = key, [], None
        self.state, self.seats = 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.last = None
        self.hash, self.empty, self.audit = hashlib.sha256(), True, []

    def edits(self, grammar):
        """(edit, symbol or None) of the whole conversation, piece by piece."""
        for word, (i, j) in zip(self.words, self.way):
            symbols = iter(grammar.spell(word))
            audit = text_of(grammar.product(word)[i][j][1])
            self.audit.append(audit)
            for e in audit:
                yield e, (None if e == "I" else next(symbols))
            self.end = j
        tail = END[self.end][1]
        self.audit.append(tail)
        for e in tail:
            yield e, None

    def start(self, grammar):
        self.cost, self.way = choose([grammar.product(w) for w in self.words])
        self.plan = self.edits(grammar)

    def put(self, edit, role, text):
        initial = role[:1]
        self.state = _AFTER[initial]
        self.hash.update((("" if self.empty else "\n") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.empty = False
        self.seats += 1
        return (*self.key, self.seats, edit, role, text)

    def _made(self):
        return "assistant" if self.state == 2 else "user"

    def turn(self, turned, turn, role, text):
        """Take one turn; gives the repaired turns up to and with it."""
        if turned and turn != self.high:
            self.low, self.high, self.turns = (turn if self.low is None else self.low), turn, self.turns + 1
        initial = role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        edit, symbol = next(self.plan)
        while edit == "I":
            yield self.put(edit, self._made(), "")
            edit, symbol = next(self.plan)
        if symbol == "X":
            if text.strip(WHITE):
                self.duplicate += 1
            else:
                self.blank += 1
        elif symbol.isupper():
            self.truncated += 1
        if edit != "D":
            yield self.put(edit, self._made() if edit == "R" else role, text)

    def finish(self):
        for edit, _ in self.plan:
            yield self.put(edit, self._made(), "")

    def report(self):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (*self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                "".join(self.audit), self.hash.hexdigest())


REPORT = (f"{SHAPE}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
REPAIRED = f"{SHAPE}, seat long, edit string, role string, text string"


def _walked(turns: DataFrame, size: int, reports: bool) -> DataFrame:
    pieces = common.written(pieces_of(symbol_runs(turns), size), "pieces")
    grammar = re_pair(pieces)
    shared = turns.sparkSession.sparkContext.broadcast(grammar.rules)
    none = lambda kind: F.lit(None).cast(kind)
    words = pieces.select(*KEYS, F.lit(False).alias("turned"), F.col("place").alias("turn0"), none("string").alias("role"),
                          none("string").alias("digest"), none("string").alias("text"),
                          grammar.compressed(F.col("symbols")).alias("word"))
    rows = words.unionByName(_lines(turns).withColumn("word", none("string")))
    rows = rows.withColumn("is_turn", F.col("word").isNull())
    schema = REPORT if reports else REPAIRED
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [tuple(f.strip().split(" ")) for f in schema.split(",")]

    def run(batches):
        rules = Grammar(shared.value)
        conv, out = None, []

        def flat():
            cols = list(zip(*out)) or [()] * len(fields)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(cols, fields)],
                                              [n for n, _ in fields])

        def close():
            rest = list(conv.finish())
            out.extend([conv.report()] if reports else rest)

        for b in batches:
            for keyless, key, turned, turn, role, text, word in zip(*(b.column(c).to_pylist() for c in (
                    "keyless", "key0", "turned", "turn0", "role", "text", "word"))):
                if conv is None or conv.key != (keyless, key):
                    if conv is not None:
                        close()
                    conv = _Conversation((keyless, key))
                if word is not None:
                    conv.words.append(word)
                    continue
                if conv.plan is None:
                    conv.start(rules)
                for row in conv.turn(turned, turn, role, text):
                    if not reports:
                        out.append(row)
            yield flat()
        if conv is not None:
            close()
        yield flat()

    order = [*KEYS, "is_turn", *LINE]
    return (rows.repartition(*KEYS).sortWithinPartitions(*order)
            .select(*KEYS, "turned", "turn0", "role", "text", "word").mapInArrow(run, schema))


def _conv_id():
    return F.when(~F.col("keyless"), F.col("key0")).alias("conv_id")


def repaired(turns: DataFrame, size: int = PIECE) -> DataFrame:
    """(conv_id, seat, edit, role, text): the repaired turns of every
    conversation, numbered from 1; ``edit`` is K, R or I."""
    return _walked(turns, size, False).select(_conv_id(), "seat", "edit", "role", "text")


def report(turns: DataFrame, conversations: DataFrame | None = None, size: int = PIECE) -> DataFrame:
    """Faults, cost, audit and hash of every conversation of ``turns``, and
    with nothing but zeros those that only ``conversations`` (conv_id) has."""
    found = _walked(turns, size, True)
    if conversations is None:
        return found.select(_conv_id(), *found.columns[2:])
    conv = F.col("conv_id").cast("long")
    every = conversations.select(conv.isNull().alias("keyless"),
                                 F.coalesce(conv, F.lit(0).cast("long")).alias("key0")).distinct()
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in found.columns[2:8]]
    return every.join(found, KEYS, "left").select(
        _conv_id(), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_HASH)).alias("repaired_sha256"))
