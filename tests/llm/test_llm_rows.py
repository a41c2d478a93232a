"""Quality rules, language ID, toxicity, sharding against brute force."""
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SF001
from llm_fixtures import empty, odd, odd_rows, small  # noqa: F401 (fixtures)
from pyspark.sql import functions as F
from strata.llm import common, langid, quality, queries, shuffle, toxicity

SF01 = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    ws = WORD.findall(t)
    n = len(ws)
    seen = Counter(tuple(ws[i:i + 5]) for i in range(n - 4))
    covered = {j for i in range(n - 4) if seen[tuple(ws[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def figures(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_op2(spark):
    con = duckdb.connect()
    docs = dict(con.execute(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall())
    good = dict(con.execute(f"SELECT doc_id, quality FROM '{SF01}/labels.parquet'").fetchall())
    rows = queries.QUERIES["op2_ngram_ratio_rules"](spark, SF01).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(figures(r) == base(docs[r.doc_id]) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)
    lost = [r for r in rows if good.get(r.doc_id) == 1 and not r.base_failed and not r.kept]
    junk = [r for r in rows if good.get(r.doc_id) == 0]
    assert not lost and sum(r.kept for r in junk) <= 0.05 * len(junk)


def trigrams(text):
    """Each word's characters, three by three from its head on."""
    return [w[i:i + 3] for w in WORD.findall(text) for i in range(0, len(w), 3)]


def test_ratio_is_the_mean_of_log_ratios(spark):
    rows = [(1, "good words are good words here"), (2, "bad%% worse%% words%%"), (3, "good here"), (4, "é" * 70 + " x 中")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    got = {r.doc_id: r.llr for r in quality.quality_rules(docs, labels).collect()}
    every = sorted({g for _, t in rows for g in trigrams(t)})
    of = {r.g: r.b for r in spark.createDataFrame([(g,) for g in every], "g string").select(
        "g", F.pmod(F.xxhash64("g"), F.lit(quality.BUCKETS)).alias("b")).collect()}
    raw, trusted = (Counter(of[g] for k, t in rows if k in ks for g in trigrams(t)) for ks in ((1, 2, 3, 4), (1,)))
    n = quality.BUCKETS
    weight = lambda b: (np.log((trusted[b] + 1) / (sum(trusted.values()) + n))
                        - np.log((raw[b] + 1) / (sum(raw.values()) + n)))
    for k, t in rows:
        assert got[k] == pytest.approx(np.mean([weight(of[g]) for g in trigrams(t)]), abs=1e-3)


def every_run(text):
    """Runs of three characters at every place of each word; a shorter word itself."""
    return [w[i:i + 3] for w in WORD.findall(text) for i in range(max(1, len(w) - 2))]


def test_every_ngram_of_a_word_counts(spark):
    """N-grams at every place, also of words that share none from their heads
    on; characters beyond 16 bits, long words, odd spaces and marks."""
    import random
    rnd = random.Random(6)
    parts = ["a", "bc", "the", "😀", "中", "é", " ", "\t", "\n", "\u2003", "\x1c", "\x0b", "%", "\x85"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 60))) for _ in range(200)] + ["x" * 5000, "", "x😀 ab😀 😀😀 😀"]
    found = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select(quality.grams(F.col("t"), True).alias("g"))
    assert [r.g for r in found.collect()] == [every_run(t) for t in [*texts, ""]]
    rows = [(1, "reading mountains often " * 5), (2, "xreading xmountains xoften " * 5), (3, None), (1, "éa 中 😀😀😀😀"), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    got = [r.llr for r in quality.quality_rules(docs, labels, every=True).collect()]
    grams = sorted({g for _, t in rows for g in every_run(t or "")})
    of = {r.g: r.b for r in spark.createDataFrame([(g,) for g in grams], "g string").select(
        "g", F.pmod(F.xxhash64("g"), F.lit(quality.BUCKETS)).alias("b")).collect()}
    raw, trusted = (Counter(of[g] for k, t in rows if k in ks for g in every_run(t or "")) for ks in ((1, 2, 3, None), (1,)))
    n = quality.BUCKETS
    weight = lambda b: (np.log((trusted[b] + 1) / (sum(trusted.values()) + n))
                        - np.log((raw[b] + 1) / (sum(raw.values()) + n)))
    for x, (_, t) in zip(got, rows, strict=True):
        assert x == pytest.approx(np.mean([weight(of[g]) for g in every_run(t)]) if t else 0, abs=1e-3)


def test_the_query_takes_every_ngram(spark, monkeypatch):
    """op2 counts and rates n-grams at every place."""
    seen, grams = [], quality.grams
    monkeypatch.setattr(quality, "grams", lambda text, every=False: seen.append(every) or grams(text, every))
    queries.QUERIES["op2_ngram_ratio_rules"](spark, SF001)
    assert len(seen) == 2 and all(seen)


def test_only_texts_that_may_be_trusted_are_shuffled(spark, monkeypatch):
    """At any size: no broadcast of keys while they are few, no text shuffled
    that the bit table rules out; rows that repeat, and without key, stay."""
    rows = [(i if i % 50 else None, f"text {i}") for i in range(2000)] + [(7, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 2)) for i in range(1000)] + [(7, 1), (7, 1), (None, 1)],
                                   "doc_id long, quality int")
    want = sorted((int(k is not None and (k < 1000 and k % 5 == 2 or k == 7)), t) for k, t in rows)
    assert sorted(map(tuple, quality.counted_texts(docs, labels).collect())) == want
    monkeypatch.setattr(quality, "BITS", 64)  # most texts only seem trusted
    out = quality.counted_texts(docs, labels)
    assert sorted(map(tuple, out.collect())) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastExchange") >= 1


def test_junk_is_seen_wherever_it_stands(spark):
    """Symbols at the head, inside or at the end of words, and between them."""
    import random
    rnd = random.Random(4)
    clean = [" ".join(rnd.choice(["the", "and", "for", "with", "from", "river", "mountain", "reading", "often"])
                      for _ in range(40)) + f" {i}" for i in range(300)]
    spoil = [lambda w: f"###{w}", lambda w: f"{w[:2]}%$&{w[2:]}", lambda w: f"{w}|||", lambda w: f"<br>{w}", lambda w: f"{w} @@@"]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(1000 + i, " ".join(spoil[i % 5](w) for w in clean[i].split())) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(150)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.quality_rules(docs, labels).collect() if r.kept}
    base_kept = {i for i, t in rows if not base(t)[-1]}
    assert kept == {i for i in base_kept if i < 1000}


def test_quality_odd(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame([(None, 1), (5, 1), (5, 1), (11, None)], "doc_id long, quality int")
    got = [(r.doc_id, *figures(r)) for r in quality.quality_rules(odd, labels).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted([(k, *base(t)) for k, t in odd_rows], key=key)
    assert quality.quality_rules(empty, labels.limit(0)).collect() == []
    # nothing trusted: the base rules alone decide
    assert all(r.kept != r.base_failed for r in quality.quality_rules(odd, labels.limit(0)).collect())


def crc(k):
    return zlib.crc32(str(k).encode())


def test_op3(spark):
    con = duckdb.connect()
    docs = {k: (t, lang) for k, t, lang in con.execute(f"SELECT doc_id, text, lang FROM '{SF01}/documents.parquet'").fetchall()}
    rows = queries.QUERIES["op3_byte_cnn_langid"](spark, SF01).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id][1] for r in held]) >= 0.97


def test_cnn_tables_equal_the_convolution():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (40, langid.WINDOW)).astype(np.uint8)
    net = langid.ByteCnn.train(["a", "b"], x, np.arange(40) % 2)
    e, maxima = net.emb[x], []
    for w, k, bias in zip(langid.WIDTHS, net.conv, net.bias):
        flat = np.stack([e[:, i:i + w].reshape(40, -1) for i in range(langid.WINDOW - w + 1)], 1)
        maxima.append((flat @ k).max(1) + bias)
    z = np.maximum(np.concatenate(maxima, 1), 0) @ net.out + net.out_bias
    want = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert np.allclose(net.probabilities(x), want, atol=1e-4)


@pytest.mark.parametrize("n", [0, 1, 4, 255, 256, 257, 509, 510, 4000])
def test_windows_cover_every_gram(n):
    raw = bytes(i % 250 + 1 for i in range(n))
    x, step = langid.windows(raw), langid.WINDOW - max(langid.WIDTHS) + 1
    assert x.shape[1] == langid.WINDOW
    grams = {(i * step + j) for i in range(len(x)) for j in range(langid.WINDOW - 3)}
    assert set(range(max(0, n - 3))) <= grams
    assert all(bytes(x[i]).rstrip() == raw[i * step:i * step + langid.WINDOW].rstrip() for i in range(len(x)))


def test_langid_odd(odd, odd_rows, empty):
    rows = langid.identify(odd).collect()
    assert len(rows) == len(odd_rows) and {r.lang_pred for r in rows} == {"und"}  # nothing to learn from
    assert langid.identify(empty).collect() == []
    learned = odd.withColumn("lang", F.when(F.length("text") % 2 == 0, "x").otherwise("y"))
    many = learned
    for _ in range(3):
        many = many.unionByName(many.withColumn("doc_id", F.col("doc_id") + 1000))
    rows = langid.identify(many).collect()
    blank = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {0, 1, 2, 12, 13} <= blank and not {3, 5, 11} & blank


def test_op10(spark):
    sf = "/root/testdata/sf0.1"
    toxic = dict(duckdb.connect().execute(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    rows = queries.QUERIES["op10_clause_grammar_toxicity"](spark, sf).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 10_000
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    hit = [r.predicted for r in held if toxic[r.doc_id]]
    false = [r.predicted for r in held if not toxic[r.doc_id]]
    assert np.mean(hit) >= 0.8 and np.mean(false) <= 0.02


def kinds(text, entries):
    return [toxicity.KINDS[k] for k in toxicity.Lexicon(entries).clauses(text)]


def test_clause_grammar():
    lex = {"idiot": toxicity.INSULT, "foo+": toxicity.SUSPECT, "bar$": toxicity.INSULT}
    # (sure, suspected, negated, threat, target, reported)
    assert kinds("What an idiot.", lex) == [(1, 0, 0, 0, 0, 0)]
    assert kinds("You idiots!", lex) == [(1, 0, 0, 0, 1, 0)]
    assert kinds("he is not an idiot", lex) == [(0, 0, 1, 0, 1, 0)]
    assert kinds("not that it matters to me, idiot", lex) == [(1, 0, 0, 0, 0, 0)]
    assert kinds('He said "idiot".', lex) == [(1, 0, 0, 0, 1, 1)]
    assert kinds("I will kill you", lex) == [(0, 0, 0, 1, 1, 0)]
    assert kinds("kill the lights. barn foo", lex) == []
    assert kinds("food; bar", lex) == [(0, 1, 0, 0, 0, 0), (1, 0, 0, 0, 0, 0)]
    assert kinds("IDIOT%%% idiot\nnidiot", lex) == [(1, 0, 0, 0, 0, 0)]


def test_weights_follow_the_labels():
    flat = [0] * len(toxicity.KINDS)
    one = lambda k: [int(i == toxicity.KIND[k]) for i in range(len(flat))]
    sure, negated = (1, 0, 0, 0, 0, 0), (0, 0, 1, 0, 0, 0)
    w, b = toxicity.logistic([flat, one(sure), one(negated)], [0, 1, 0], [500, 60, 60])
    at = lambda k: 1 / (1 + np.exp(-b - toxicity.features(one(k)) @ w))
    assert at(sure) > 0.9 and at(negated) < 0.1


def test_toxicity_odd(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame([(None, 1), (5, 1), (5, 0), (11, None), (7, 0), (7, 0)], "doc_id long, toxic int")
    rows = toxicity.rate(odd, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.rate(empty, labels.limit(0)).collect() == []
    clean = toxicity.drop_toxic(odd, toxicity.Model(toxicity.Lexicon({"same": 0}), np.full(len(toxicity.KINDS), 9.0), -3.0))
    assert clean.columns == odd.columns and clean.count() == len(odd_rows) - 3


def check_shards(rows, texts, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(texts)


def test_op5(spark, small):
    rows = queries.QUERIES["op5_two_pass_shuffle"](spark, SF001).collect()
    texts = {k: (t or "").encode() for k, t, _ in small}
    check_shards(rows, texts, 40)
    assert {(r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in rows} == \
        {(k, len(t) + 16, zlib.crc32(t), "rows", None) for k, t in texts.items()}


def test_shuffle_odd(spark, odd, odd_rows, empty, monkeypatch):
    out = shuffle.write_shuffled(odd, common.scratch(spark, "shuffle"), shards=4, bucket_bytes=60_000)
    assert sorted(out.columns) == sorted(odd.columns)
    rows = out.collect()
    check_shards(rows, odd_rows, 4)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r.doc_id, r.text) for r in rows], key=key) == sorted(odd_rows, key=key)
    again = shuffle.write_shuffled(odd.repartition(7), common.scratch(spark, "shuffle"), shards=4, bucket_bytes=60_000)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, rows))  # order of input does not matter
    monkeypatch.setattr(shuffle, "BROADCAST_BUCKETS", 0)
    joined = shuffle.write_shuffled(odd, common.scratch(spark, "shuffle"), shards=4, bucket_bytes=60_000)
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, rows))
    assert shuffle.write_shuffled(empty, common.scratch(spark, "shuffle"), shards=4).collect() == []


def test_equal_records_spread_over_buckets(spark, scratch):
    """A third of the rows are equal, and a third share key and text: no bucket
    above twice its size, all rows there, the same order from any partitions."""
    text = "one text that many rows share, " * 8
    rows = [(7, text, "a", 1)] * 700 + [(8, text, f"s{i}", i) for i in range(700)]
    rows += [(100 + i, f"{text} {i}", "b", i) for i in range(700)] + [(None, None, None, None)] * 3
    schema = "doc_id long, text string, source string, bucket long"
    size, seen = 20_000, []
    for i, parts in enumerate((2, 9)):
        docs = spark.createDataFrame(rows, schema).repartition(parts)
        out = shuffle.write_shuffled(docs, f"{scratch}/{i}", shards=5, bucket_bytes=size)
        seen.append(sorted(((r.shard, r.slot, r.doc_id, r.source, r.bucket) for r in out.collect()), key=repr))
        buckets = spark.read.parquet(f"{scratch}/{i}/buckets").groupBy("bucket").agg(
            F.sum(F.coalesce(F.octet_length("r.text"), F.lit(0)) + 16).alias("b")).collect()
        assert max(r.b for r in buckets) <= 2 * size and len(buckets) >= 20
    assert seen[0] == seen[1]
    assert Counter(r[2:] for r in seen[0]) == Counter((k, s, b) for k, _, s, b in rows)


def test_fisher_yates_is_uniform():
    counts = Counter(tuple(shuffle.fisher_yates(3, np.random.default_rng(i)).tolist()) for i in range(6000))
    assert len(counts) == 6 and min(counts.values()) > 850


# -- whole clauses, hot keys -------------------------------------------------

def every_clause(lexicon, text):
    """Kinds of all clauses, each read from its start, by cutting the text."""
    out = []
    for clause in re.split(r"[.!?;:\n]", text.lower()):
        state = 0
        for w in toxicity._WORD.findall(clause):
            state = toxicity.MACHINE.step[state][lexicon.word_class(w)][0]
        kind = toxicity.KIND.get(toxicity.MACHINE.final[state])
        if kind is not None:
            out.append(kind)
    return out


def test_every_clause_is_read_from_its_start():
    """The scan by automaton against reading every clause: random words, far
    targets and reports, entries inside words, clauses of any length."""
    import random
    lexicon = toxicity.Lexicon({"idio": toxicity.INSULT, "ass$": toxicity.INSULT, "moro+": toxicity.SUSPECT, "cl": toxicity.SUSPECT})
    words = ["idiot", "class", "ass", "moron", "moro", "clown", "you", "not", "said", "kill", "hurt", "don't", "plain", "\"",
             "x" * 30, "idio'ass", "über", "killer"]
    rnd = random.Random(7)
    for n in (1, 3, 10, 60, 400):
        for _ in range(60):
            ends = [" ", " ", " ", " ", ", ", ". ", "; ", "\n", "!?", "-"] if n < 400 else [" "]
            text = "".join(rnd.choice(words) + rnd.choice(ends) for _ in range(n))
            assert list(lexicon.clauses(text)) == every_clause(lexicon, text), text
    far = " ".join(["filler"] * 1000)
    for text in (f"you {far} kill", f"he said {far} idiot", f"{far} class {far}", f"{'x' * 5000} ass", f"you. {far} kill"):
        assert list(lexicon.clauses(text)) == every_clause(lexicon, text)
    threat = toxicity.KIND[(0, 0, 0, 1, 1, 0)]
    assert list(lexicon.clauses(f"you {far} kill")) == [threat] and not list(lexicon.clauses(f"you. {far} kill"))


def test_samples_are_bounded_when_keys_are_shared(spark, monkeypatch):
    """A third of the rows without key, a third under one labelled key."""
    monkeypatch.setattr(langid, "PER_LANG", 20)
    monkeypatch.setattr(toxicity, "PER_CLASS", 15)
    n = 900
    rows = [(None if i % 3 == 0 else 1 if i % 3 == 1 else i, f"some words of text number {i} to learn from", "en" if i % 2 else "de")
            for i in range(n)]
    docs = spark.createDataFrame(rows + [rows[0]] * 300, "doc_id long, text string, lang string").repartition(4)
    windows = langid.sample(docs, F.lit(True)).groupBy("lang").count().collect()
    assert {r["lang"] for r in windows} == {"en", "de"} and all(r["count"] <= 20 * langid.PER_TEXT for r in windows)
    labels = spark.createDataFrame([(1, 1), *[(i, i % 2) for i in range(2, n)]], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels, F.lit(True)).collect()
    assert len({r.doc_id for r in sample}) == len(sample) <= 30
    assert sorted(map(tuple, sample)) == sorted(map(tuple, toxicity.labelled_sample(docs.repartition(9), labels, F.lit(True)).collect()))


def test_every_trusted_document_counts(spark):
    labels = spark.range(25_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert quality.trusted_keys(labels.unionByName(labels)).count() == 25_000
