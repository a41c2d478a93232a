"""Toxicity by a weighted finite-state pattern grammar.

Five transducers read the word classes of a clause:

* INSULT: has a sure or a suspected insult occurred, and was it in the scope
  of a negation;
* THREAT: has a threat word occurred;
* TARGET: is a person addressed or named by a pronoun;
* NEGATION: is a negation at most ``SCOPE`` words back (feeds INSULT);
* REPORT: is the clause reported speech (a verb of saying, or quotation marks).

Their composition is one machine whose final state names the kind of the
clause. A text's score is a logistic function of the clauses it matched, by
kind: the weights of the arcs into the final states, fitted on labelled rows.

The insult lexicon is learned too: word beginnings (with any or at least one
further letter) and whole words that occur in toxic texts and hardly anywhere
else, chosen greedily by how many toxic texts they explain that no earlier
entry does. They are sure or suspected by how often they are right.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: the sample: at most so many labelled rows of either class, by hash, and one
#: text of each key, so that a key which many rows share gives one row too
PER_CLASS = 12_000
#: of the fit: candidates that are weighed (those seen in most toxic texts of
#: the sample), entries that may be chosen; words a task counts before it passes them on
CANDIDATES, ENTRIES, HELD = 4096, 1024, 100_000
SURE, SUSPECTED = 0.97, 0.8
SHORTEST, LONGEST, SCOPE = 3, 12, 3

# Closed word classes of the grammar (English, German, French, Spanish).
THREATS = frozenset("kill hurt destroy burn shoot stab beat murder töten umbringen verletzen tuer tuerai frapper "
                    "matar matare golpear".split())
TARGETS = frozenset("you your he she they him her them his their who du dich dir euch sie ihr er tu te toi vous il "
                    "elle ils tú usted él ella ellos".split())
NEGATIONS = frozenset("not no never none neither nor isn't aren't wasn't don't doesn't nicht kein keine nie pas jamais "
                      "aucun nunca jamás ningún".split())
REPORTS = frozenset("said says say told called calls claimed wrote quoted sagte sagt dit disait dijo dice".split())

_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[\"“”«»„]")
_CLAUSE_END = re.compile(r"[.!?;:\n]")
QUOTES = frozenset('"“”«»„')

# symbols of the machine
INSULT, SUSPECT, THREAT, TARGET, NEGATION, REPORT, OTHER, NEGATED = range(8)


class Transducer:
    """Total deterministic transducer over the word classes: ``step[state][c]``
    is (next state, output class); ``final[state]`` is what it reports."""

    def __init__(self, step, final):
        self.step, self.final = step, final

    def then(self, other: Transducer) -> Transducer:
        """Composition: ``other`` reads what this one writes; both report."""
        n = len(other.step)
        step, final = [], []
        for a, b in product(range(len(self.step)), range(n)):
            row = []
            for c in range(len(self.step[a])):
                a2, out = self.step[a][c]
                b2, out2 = other.step[b][out]
                row.append((a2 * n + b2, out2))
            step.append(row)
            final.append(self.final[a] + other.final[b])
        return Transducer(step, final)


def flag(symbols) -> Transducer:
    """Reports 1 once one of ``symbols`` was read, else 0; copies its input."""
    width = NEGATED + 1
    return Transducer([[(1 if s or c in symbols else 0, c) for c in range(width)] for s in (0, 1)], [(0,), (1,)])


def negation() -> Transducer:
    """State: words left in the scope. It writes NEGATED for an insult inside."""
    step = []
    for s in range(SCOPE + 1):
        row = []
        for c in range(NEGATED + 1):
            nxt = SCOPE if c == NEGATION else max(0, s - 1)
            row.append((nxt, NEGATED if c in (INSULT, SUSPECT) and s else c))
        step.append(row)
    return Transducer(step, [()] * (SCOPE + 1))


#: (sure insult, suspected, negated, threat, target, reported) of a clause
MACHINE = (negation().then(flag({INSULT})).then(flag({SUSPECT})).then(flag({NEGATED})).then(flag({THREAT}))
           .then(flag({TARGET})).then(flag({REPORT})))
#: clause kinds that count: an insult, a negated insult, or a targeted threat
KINDS = [k for k in product((0, 1), repeat=6) if k[0] or k[1] or k[2] or (k[3] and k[4])]
KIND = {k: i for i, k in enumerate(KINDS)}


def forms(word: str):
    """Entries that a word matches: beginnings, beginnings with at least one
    letter more (``+``), the whole word (``$``)."""
    for k in range(SHORTEST, min(len(word), LONGEST) + 1):
        yield word[:k]
        if len(word) > k:
            yield word[:k] + "+"
    yield word + "$"


class Lexicon:
    """``entries``: form -> INSULT or SUSPECT."""

    def __init__(self, entries: dict):
        import ahocorasick
        self.entries = dict(entries)
        self.auto = ahocorasick.Automaton()
        for e in sorted({e.rstrip("+$") for e in self.entries} | THREATS):
            self.auto.add_word(e, len(e))
        self.auto.make_automaton()

    def word_class(self, w: str) -> int:
        found = [c for f in forms(w) if (c := self.entries.get(f)) is not None]
        if found:
            return min(found)
        if w in THREATS:
            return THREAT
        if w in TARGETS:
            return TARGET
        if w in NEGATIONS:
            return NEGATION
        return REPORT if w in REPORTS or w in QUOTES else OTHER

    def clauses(self, text: str):
        """Kinds of the clauses of ``text`` that match, one per clause."""
        if not text:
            return
        low, done = text.lower(), -1
        start, ends = 0, _CLAUSE_END.finditer(low)
        end_of = next(ends, None)
        for end, size in self.auto.iter(low):
            at = end - size + 1
            if at < done or (at and low[at - 1].isalnum()):
                continue
            # the ends are passed once, however long a clause is; hits inside
            # one word may come out of order, but no clause ends in a word
            while end_of is not None and end_of.start() < at:
                start, end_of = end_of.end(), next(ends, None)
            stop = end_of.start() if end_of is not None else len(low)
            done = stop
            state = 0
            for w in _WORD.findall(low, start, stop):
                state = MACHINE.step[state][self.word_class(w)][0]
            kind = KIND.get(MACHINE.final[state])
            if kind is not None:
                yield kind


def features(counts) -> np.ndarray:
    """Saturating counts per kind."""
    return np.log1p(np.asarray(counts, np.float64))


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray, bias: float):
        self.lexicon, self.weights, self.bias = lexicon, weights, bias

    def counts(self, text: str) -> list[int]:
        out = [0] * len(KINDS)
        for k in self.lexicon.clauses(text):
            out[k] += 1
        return out

    def score(self, text: str) -> float:
        z = self.bias + float(features(self.counts(text)) @ self.weights)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def labelled_sample(docs: DataFrame, labels: DataFrame, learn) -> DataFrame:
    """(doc_id, text, toxic, weight): at most ``PER_CLASS`` labelled rows of
    each class, chosen by hash among those where ``learn`` holds, of the rows
    that share a key the text of smallest hash; ``weight`` is how many labelled
    rows each stands for."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(learn)
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    known = common.written(known, "toxic-labels")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS)
             .withColumn("weight", F.lit(max(1.0, sizes.get(c, 0) / PER_CLASS))) for c in (0, 1)]
    # at most 2 * PER_CLASS rows are broadcast
    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(F.col("text").isNotNull())
            .join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id"))
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    return (rows.groupBy("doc_id", "toxic", "weight").agg(one)
            .select("doc_id", F.col("one.text").alias("text"), "toxic", "weight"))


def _words(text: str) -> set:
    return {w for w in _WORD.findall(text.lower()) if len(w) >= SHORTEST}


def learn_lexicon(sample: DataFrame) -> dict[str, int]:
    """Greedy choice among the candidates; see the module's text."""

    def count(batches):
        held: Counter = Counter()
        for b in batches:
            for t, c in zip(b.column(0), b.column(1).to_pylist()):
                held.update((w, c) for w in _words(t.as_py()))
                if len(held) > HELD:
                    yield _counted(held)
                    held.clear()
        yield _counted(held)

    totals = {r["toxic"]: r for r in sample.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")).collect()}
    if len(totals) < 2:
        return {}
    words = (common.map_arrow(sample.select("text", "toxic"), count, "word string, toxic int, n long")
             .groupBy("word").agg(F.sum(F.col("n") * F.col("toxic")).alias("bad"),
                                  F.sum(F.col("n") * (1 - F.col("toxic"))).alias("fine")))
    words = common.written(words, "toxic-words")
    sizes = F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST)))
    begins = F.transform(sizes, lambda k: F.substring(F.col("word"), F.lit(1), k))
    more = F.transform(F.filter(begins, lambda x: F.length(x) < F.length("word")), lambda x: F.concat(x, F.lit("+")))
    entries = (words.select(F.explode(F.concat(begins, more, F.array(F.concat("word", F.lit("$"))))).alias("entry"),
                            "bad", "fine").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine")))
    # how often an entry is right among all labelled rows, not just the sampled
    right = F.col("bad") * totals[1]["weight"] / (
        F.col("bad") * totals[1]["weight"] + F.col("fine") * totals[0]["weight"])
    rows = (entries.where(F.col("bad") >= 3).withColumn("right", right).where(F.col("right") >= SUSPECTED)
            .orderBy(F.desc("bad"), "entry").limit(CANDIDATES).collect())  # bounded
    bad, right = {r["entry"]: r["bad"] for r in rows}, {r["entry"]: r["right"] for r in rows}
    # an entry that a longer one matches nearly as often leaves its place to it
    weaker = {f for e in bad for f in forms(e.rstrip("+$"))
              if f != e and f[-1] != "$" and f in bad and bad[e] >= 0.97 * bad[f] and right[e] >= right[f]}
    order = sorted(e for e in bad if e not in weaker)
    shared = sample.sparkSession.sparkContext.broadcast(order)

    def incidence(batches):
        number = {e: i for i, e in enumerate(shared.value)}
        for b in batches:
            out = [sorted({number[f] for w in _words(t.as_py()) for f in forms(w) if f in number})
                   for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32()))], ["hits"])

    hits = [r["hits"] for r in sample.where(F.col("toxic") == 1).select("text")
            .mapInArrow(incidence, "hits array<int>").collect()]  # at most PER_CLASS rows
    # chance that an entry seen m times, all in toxic texts, means nothing:
    # base**m for each of the words seen; ask for less than 5 % over all
    base = totals[1]["n"] / (totals[0]["n"] + totals[1]["n"])
    least = max(3, math.ceil(math.log(0.05 / max(2, words.count())) / math.log(min(0.9, base))))
    return {e: INSULT if right[e] >= SURE else SUSPECT for e in greedy(order, hits, least)}


def greedy(entries: list[str], hits: list[list[int]], least: int) -> list[str]:
    """Entries in order of how many texts only they explain so far."""
    texts: list[list[int]] = [[] for _ in entries]
    for d, found in enumerate(hits):
        for e in found:
            texts[e].append(d)
    open_ = np.ones(len(hits), bool)
    rows = [np.array(t, np.int64) for t in texts]
    gain = np.array([len(r) for r in rows], np.int64)
    chosen = []
    while len(chosen) < ENTRIES and len(gain) and gain.max() >= least:
        e = int(gain.argmax())
        exact = int(open_[rows[e]].sum())
        if exact < gain[e]:  # the gain was counted before others were chosen
            gain[e] = exact
            continue
        chosen.append(entries[e])
        open_[rows[e]] = False
        gain[e] = 0
    # words that explain nothing more may still be as frequent as a chosen one:
    # keep those seen nearly as often
    if chosen:
        floor = max(least, 0.25 * np.median([len(rows[entries.index(c)]) for c in chosen]))
        for e in np.argsort([-len(r) for r in rows], kind="stable").tolist():
            if len(chosen) >= ENTRIES or len(rows[e]) < floor:
                break
            if entries[e] not in chosen:
                chosen.append(entries[e])
    return chosen


def _counted(held: Counter) -> pa.RecordBatch:
    keys = list(held)
    return pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in keys], pa.string()), pa.array([c for _, c in keys], pa.int32()),
         pa.array([held[k] for k in keys], pa.int64())], ["word", "toxic", "n"])


def fit(docs: DataFrame, labels: DataFrame, learn) -> Model:
    """Learn the lexicon, then the weights of the clause kinds."""
    sample = common.written(labelled_sample(docs, labels, learn), "toxic-sample")
    lexicon = Lexicon(learn_lexicon(sample))
    plain = Model(lexicon, np.zeros(len(KINDS)), 0.0)
    shared = sample.sparkSession.sparkContext.broadcast(plain)

    def count(batches):
        m = shared.value
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([m.counts(t.as_py()) for t in b.column(0)], pa.list_(pa.int64())), b.column(1), b.column(2)],
                ["counts", "toxic", "weight"])

    rows = (common.map_arrow(sample.select("text", "toxic", "weight"), count,
                             "counts array<long>, toxic int, weight double")
            .select(F.transform("counts", lambda c: F.least(c, F.lit(20))).alias("counts"), "toxic", "weight")
            .groupBy("counts", "toxic").agg(F.sum("weight").alias("weight")).collect())  # at most one row per sampled text
    rows.sort(key=lambda r: (r["counts"], r["toxic"]))
    return Model(lexicon, *logistic([r["counts"] for r in rows], [r["toxic"] for r in rows],
                                    [r["weight"] for r in rows]))


def logistic(counts, y, n, steps: int = 60) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps. Every kind starts from, and
    is drawn to, a weight that grammar gives it: an insult counts, one that is
    negated or reported less, a threat at someone as an insult."""
    prior = np.array([(4.0 if k[0] or k[3] else 2.0 if k[1] else 1.0) * (0.75 if k[5] else 1) + k[4]
                      for k in KINDS] + [-3.0])
    w = prior.copy()
    if len(y):
        x = np.hstack([features(counts), np.ones((len(y), 1))])
        y, n = np.array(y, float), np.array(n, float)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            g = x.T @ (n * (p - y)) + 0.5 * (w - prior)
            h = (x * (n * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w))
            step = np.linalg.solve(h, g)
            w = w - step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-9:
                break
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; null or empty texts get the score of a
    text without any matched clause."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([m.score(t.as_py() or "") for t in b.column(1)], pa.float64())],
                ["doc_id", "score"])

    return common.map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                            "doc_id long, score double")


def held_out():
    return F.coalesce(F.pmod(common.doc_crc(), F.lit(5)) == 0, F.lit(False))


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows that are not held out, then score every row."""
    scored = score(docs, fit(docs, labels, ~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return common.keep_rows(docs, lambda texts: [shared.value.score(t or "") < threshold for t in texts])
