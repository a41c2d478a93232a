"""Language ID by a byte convolutional network.

The network: bytes are embedded, filters of several widths slide over fixed
windows of ``WINDOW`` bytes, each filter keeps its maximum, and a softmax layer
reads the maxima. It is trained in numpy (Adam, cross entropy) on the driver
from a bounded sample of labelled texts, and applied to batches of windows that
together cover the whole text; a text's class probabilities are the mean over
its windows, weighted by their letters.

To apply it, a filter's products with the embeddings are tabled once per pair
of bytes, so a convolution is a few table look-ups and additions.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

WINDOW, EMBED, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 12
#: the sample: at most so many texts of each language (by hash of key and text),
#: so many windows of each text, and so many languages: the most frequent, of at
#: least so many texts. Others are never predicted.
PER_LANG, PER_TEXT, LANGS, LEAST = 600, 3, 64, 8
STEPS, BATCH, RATE = 500, 128, 0.01

# one byte per ASCII letter, a space for every other ASCII character
_TABLE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def clean(text: str) -> bytes:
    """Lower-cased UTF-8, runs of other characters than letters one space."""
    raw = text.lower().encode("utf-8", "replace").translate(_TABLE)
    return b" ".join(raw.split(b" ")) if b"  " not in raw else b" ".join(raw.split())


def windows(raw: bytes) -> np.ndarray:
    """Windows of ``WINDOW`` bytes that cover ``raw`` and overlap by the
    widest filter less one; spaces fill the last one."""
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(raw) - max(WIDTHS) + 1) // step))
    buf = np.frombuffer(raw.ljust((n - 1) * step + WINDOW), np.uint8)
    return np.lib.stride_tricks.as_strided(buf, (n, WINDOW), (step, 1))


class ByteCnn:
    """``langs`` and the weights; ``probabilities`` of a batch of windows."""

    def __init__(self, langs, emb, conv, bias, out, out_bias):
        self.langs, self.emb, self.conv, self.bias = langs, emb, conv, bias
        self.out, self.out_bias = out, out_bias
        self._tables = None

    @classmethod
    def train(cls, langs: list[str], x: np.ndarray, y: np.ndarray, seed: int = 5) -> ByteCnn:
        rng = np.random.default_rng(seed)
        c, width = len(langs), len(WIDTHS) * FILTERS
        p = {"emb": rng.normal(0, 0.5, (256, EMBED)), "out": rng.normal(0, 0.1, (width, c)), "ob": np.zeros(c)}
        for w in WIDTHS:
            p[f"w{w}"] = rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS))
            p[f"b{w}"] = np.zeros(FILTERS)
        p = {k: v.astype(np.float32) for k, v in p.items()}
        m = {k: np.zeros_like(v) for k, v in p.items()}
        s = {k: np.zeros_like(v) for k, v in p.items()}
        share = np.bincount(y, minlength=c).astype(float)
        pick = (1 / share[y]) / (1 / share[y]).sum()  # languages alike
        for step in range(1, STEPS + 1):
            rows = rng.choice(len(x), BATCH, p=pick)
            g = cls._gradient(p, x[rows], y[rows], c)
            rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return cls(langs, p["emb"], [p[f"w{w}"] for w in WIDTHS], [p[f"b{w}"] for w in WIDTHS], p["out"], p["ob"])

    @staticmethod
    def _gradient(p, x, y, c):
        e = p["emb"][x]  # (batch, window, embed)
        n, rows = len(x), np.arange(len(x))[:, None]
        tops, at = [], []
        for w in WIDTHS:
            flat = np.lib.stride_tricks.sliding_window_view(e, w, 1).transpose(0, 1, 3, 2).reshape(n, -1, w * EMBED)
            a = flat @ p[f"w{w}"]
            i = a.argmax(1)
            tops.append(np.take_along_axis(a, i[:, None, :], 1)[:, 0] + p[f"b{w}"])
            at.append((i, flat))
        h = np.concatenate(tops, 1)
        z = np.maximum(h, 0) @ p["out"] + p["ob"]
        z -= z.max(1, keepdims=True)
        q = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        q[np.arange(n), y] -= 1
        q /= n
        g = {"out": np.maximum(h, 0).T @ q + 1e-4 * p["out"], "ob": q.sum(0)}
        dh = (q @ p["out"].T) * (h > 0)
        ge = np.zeros_like(p["emb"])
        for j, (w, (i, flat)) in enumerate(zip(WIDTHS, at)):
            d = dh[:, j * FILTERS:(j + 1) * FILTERS]
            g[f"b{w}"] = d.sum(0)
            g[f"w{w}"] = np.einsum("nfk,nf->kf", flat[rows, i], d)
            de = d[:, :, None] * p[f"w{w}"].T[None]  # (batch, filter, w * embed)
            for o in range(w):
                np.add.at(ge, x[rows, i + o], de[:, :, o * EMBED:(o + 1) * EMBED])
        g["emb"] = ge
        return g

    def _pairs(self):
        if self._tables is None:
            one = [[self.emb @ k[o * EMBED:(o + 1) * EMBED] for o in range(w)] for w, k in zip(WIDTHS, self.conv)]
            pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS).astype(np.float32)
            self._tables = [(pair(t[0], t[1]), pair(t[2], t[3]) if len(t) == 4 else None,
                             t[2].astype(np.float32) if len(t) == 3 else None) for t in one]
        return self._tables

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(windows, languages)."""
        codes = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        h = []
        for (a, b, c), bias, w in zip(self._pairs(), self.bias, WIDTHS):
            n = WINDOW - w + 1
            s = a.take(codes[:, :n], axis=0)
            if b is not None:
                s += b.take(codes[:, 2:2 + n], axis=0)
            if c is not None:
                s += c.take(x[:, 2:2 + n], axis=0)
            h.append(s.max(1) + bias)
        z = np.maximum(np.concatenate(h, 1), 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def sample(docs: DataFrame, learn) -> DataFrame:
    """(lang, part): windows of a bounded, hash-chosen sample of the rows where
    ``learn`` holds and the language is known, alike for every language."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = (rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST)
             .orderBy(F.desc("n"), "lang").limit(LANGS).collect())
    share = F.lit(0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], min(1_000_000, int(1.3e6 * PER_LANG / r["n"]) + 1)).otherwise(share)
    # the share spares most rows the ranking; the rank bounds the sample where
    # rows are equal (a task keeps PER_LANG of a language before the shuffle)
    drawn = rows.withColumn("_hash", F.xxhash64("doc_id", "text")).where(
        F.pmod("_hash", F.lit(1_000_000)) < share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_hash"))
    picked = drawn.withColumn("_rank", rank).where(F.col("_rank") <= PER_LANG)
    at = [F.substring(F.col("text"), F.floor(F.length("text") * i / PER_TEXT).cast("int") + 1, F.lit(WINDOW))
          for i in range(PER_TEXT)]
    return picked.select("lang", F.explode(F.array(*at)).alias("part")).where(F.length(F.trim("part")) >= 20)


def train(docs: DataFrame, learn) -> ByteCnn | None:
    rows = sample(docs.select("doc_id", F.col("text").cast("string"), "lang"), learn).toArrow()
    lang, part = rows.column(0).to_pylist(), rows.column(1).to_pylist()
    order = sorted(range(len(lang)), key=lambda i: (lang[i], part[i]))
    langs = sorted(set(lang))
    if not langs:
        return None
    x = np.concatenate([windows(clean(part[i]))[:1] for i in order])
    return ByteCnn.train(langs, x, np.array([langs.index(lang[i]) for i in order]))


def predict(docs: DataFrame, model: ByteCnn | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row. A null text, one without any
    letter, and any text when nothing could be learned: ``und``, 0.0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            pred, score = predict_texts(shared.value, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return common.map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                            "doc_id long, lang_pred string, score double")


def predict_texts(net: ByteCnn | None, texts: pa.Array, batch: int = 256) -> tuple[list[str], list[float]]:
    """Languages and scores; windows of several texts are run together, and a
    long text's windows in several batches."""
    total: dict[int, np.ndarray] = {}
    held, owner = [], []

    def flush():
        if held:
            x, who = np.concatenate(held), np.array(owner)
            p = net.probabilities(x) * ((x != 32).sum(1) + 1e-6)[:, None]
            starts = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
            for d, v in zip(who[starts].tolist(), np.add.reduceat(p, starts)):
                total[d] = total.get(d, 0) + v
            held.clear()
            owner.clear()

    for i in range(len(texts)):
        t = texts[i].as_py()
        if net is None or not t or not any(map(str.isalpha, t)):
            continue
        x = windows(clean(t))
        for lo in range(0, len(x), batch):
            held.append(x[lo:lo + batch])
            owner.extend([i] * len(held[-1]))
            if len(owner) >= batch:
                flush()
    flush()
    pred, score = ["und"] * len(texts), [0.0] * len(texts)
    for i, v in total.items():
        p = v / v.sum()
        pred[i], score[i] = net.langs[int(p.argmax())], float(min(1.0, p.max()))
    return pred, score


def keep_known(docs: DataFrame, model: ByteCnn | None, least: float = 0.4) -> DataFrame:
    """The rows whose language is recognised with a score of ``least``, all
    columns; all rows when nothing could be learned."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(texts):
        pred, score = predict_texts(shared.value, pa.array(texts, pa.string()))
        return [p != "und" and s >= least for p, s in zip(pred, score)]

    return common.keep_rows(docs, keep)


def held_out():
    return F.coalesce(F.pmod(common.doc_crc(), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out, then predict every row."""
    model = train(docs, ~held_out())
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
