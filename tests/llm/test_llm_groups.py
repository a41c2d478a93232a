"""Near-duplicate join, components, top-k search and the pipeline."""
import random

import duckdb
import numpy as np
import pytest
from conftest import SF001
from llm_fixtures import empty, odd, odd_rows, small, table  # noqa: F401 (fixtures)
from pyspark.sql import functions as F
from strata.llm import common, components, ngram_join, queries, topk


def shingles(text, n=3):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)] if w else [])


def brute(rows, n=3, percent=90):
    """{row number: (set size, smallest key over links)}; rows without key link nothing."""
    sets = [shingles(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            o = len(a & b)
            if a and b and 100 * o >= percent * (len(a) + len(b) - o):
                up[root(i)] = root(j)
    out = []
    for i, (k, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((k, len(sets[i]), min(keys) if keys else None))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


def test_op6(spark, small):
    rows = queries.QUERIES["op6_count_vector_rtree_join"](spark, SF001).collect()
    assert ordered(rows) == ordered(brute([r[:2] for r in small]))


def test_join_odd(odd, odd_rows, empty):
    assert ordered(ngram_join.near_duplicates(odd).collect()) == ordered(brute(odd_rows))
    assert ngram_join.near_duplicates(empty).collect() == []


def chains(seed):
    """Groups of near copies, chains whose ends do not link, sizes at the edge."""
    rnd, rows = random.Random(seed), []
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    for size in (8, 11, 12, 21, 40, 60, 121, 300):
        text = [word() for _ in range(size)]
        for _ in range(9):
            rows.append(" ".join(text))
            rows.append(" ".join(text).upper().replace(" ", "\n"))
            for _ in range(rnd.randint(0, max(1, size // 40))):
                text[rnd.randrange(size)] = word()
    rnd.shuffle(rows)
    return [(100 + i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("tile", [2048, 4])
def test_join_of_chains(spark, monkeypatch, tile):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    monkeypatch.setattr(ngram_join, "BUNDLE", 7)
    rows = chains(tile)
    want = brute(rows)
    assert len({r[2] for r in want}) > 8
    assert ordered(ngram_join.near_duplicates(table(spark, rows).repartition(3)).collect()) == ordered(want)


def test_blocks_leave_one_equal():
    rnd = np.random.default_rng(4)
    for n in [9, 10, 11, 13, 14, 17, 18, 19, 45, 90, 91, 200, 777]:
        for _ in range(20):
            a = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64))
            grow, drop = rnd.integers(0, n // 9 + 1, 2)
            b = np.unique(np.concatenate([a[drop:], rnd.integers(0, 2**63, grow).astype(np.uint64)]))
            if ngram_join.linked(a, b):
                assert np.intersect1d(ngram_join.block_keys(a), ngram_join.block_keys(b)).size


def test_tree_loses_no_pair():
    rnd = np.random.default_rng(5)
    pool = np.unique(rnd.integers(0, 2**63, 500).astype(np.uint64))
    sets = [np.sort(rnd.choice(pool, rnd.integers(440, 500), replace=False)) for _ in range(80)]
    found = ngram_join.join_tile(np.arange(80), sets, np.ones(80, bool), np.full(80, -1))
    up = list(range(80))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(80):
        for j in range(i):
            if ngram_join.linked(sets[i], sets[j]):
                up[max(root(i), root(j))] = min(root(i), root(j))
    assert sorted(found) == [(i, root(i)) for i in range(80) if root(i) != i]


def test_join_leaves_the_session_as_it_was(spark, small):
    """Spark ML works in a session that has joined, and only the tables that
    the result reads are left."""
    import os
    from strata.plans import classifier
    from strata.session import checkpoint_dir
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    docs = table(spark, small)
    joined = ngram_join.near_duplicates(docs)
    assert sorted(n.split("-")[1] for n in set(os.listdir(folder)) - before if n.startswith("llm-")) == ["classes", "sets"]
    assert joined.count() == len(small)
    assert len(classifier.classify(docs, "doc_id", "text").collect()) == len(small)


@pytest.mark.parametrize("held, bucket", [(50, 40), (10**6, 10**6)])
def test_small_runs_and_buckets_join_alike(spark, monkeypatch, held, bucket):
    monkeypatch.setattr(ngram_join, "KEYS_HELD", held)
    monkeypatch.setattr(ngram_join, "BUCKET_KEYS", bucket)
    monkeypatch.setattr(ngram_join, "HASHES", 900)
    rows = chains(bucket)
    assert ordered(ngram_join.near_duplicates(table(spark, rows).repartition(3)).collect()) == ordered(brute(rows))


def test_packed_keys_come_back():
    rnd = np.random.default_rng(8)
    keys, classes = rnd.integers(0, 2**63, 5000).astype(np.uint64), rnd.integers(-50, 50, 5000)
    seen = []
    for bucket, data in ngram_join._packed(keys, classes, 7):
        k, s = ngram_join._unpacked(data)
        seen += zip(k.tolist(), s.tolist())
        assert len(data) < 8 * len(k)
    low = (1 << 8 * ngram_join.KEY_BYTES) - 1
    assert sorted(seen) == sorted(zip((keys & np.uint64(low)).tolist(), classes.tolist()))


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (9, 9), (7, 8), (8, 7), (7, 8)] + [(i, i + 1) for i in range(100, 140)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {1: 1, 2: 1, 3: 1, 9: 1, 7: 7, 8: 7} | {i: 100 for i in range(100, 141)}
    assert len(got) == len(want) and {r.node: r.label for r in got} == want
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def exact(vectors, queries_, k):
    """{query: [(score, key)]} by brute force."""
    out = []
    for q, v in queries_.items():
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors.items() if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_op9(spark):
    con = duckdb.connect()
    vs = {i: np.floor(64 * np.array(v, np.float64)).astype(int).tolist() for i, v in
          con.execute(f"SELECT vec_id, embedding FROM '{SF001}/embeddings.parquet'").fetchall()}
    rows = queries.QUERIES["op9_cover_tree_topk"](spark, SF001).collect()
    assert sorted(map(tuple, rows)) == exact(vs, {i: v for i, v in vs.items() if i % 20 == 0}, 20)


def test_topk_odd(spark, monkeypatch):
    monkeypatch.setattr(topk, "DATA_BLOCK", 7)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "PIVOTS", 3)
    monkeypatch.setattr(topk, "SEEDS", 5)
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)]) for i in range(60)]  # many ties
    bad = [(70, None), (71, [1.0, None, 0.0]), (72, [float("nan"), 0.0, 0.0]), (73, [float("inf"), 0.0, 0.0]),
           (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows + bad + rows[:5], "vec_id long, embedding array<float>")
    v = topk.integer_vectors(df)
    vs = {i: [int(np.floor(64 * x)) for x in e] for i, e in rows}
    qs = {i: x for i, x in vs.items() if i % 20 == 0}
    got = topk.top_k(v, v.where(F.col("vec_id") % 20 == 0), k=4).collect()
    assert sorted(map(tuple, got)) == exact(vs, qs, 4)
    few = topk.top_k(v.where("vec_id < 3"), v.where("vec_id = 0"), k=4).collect()
    assert sorted(map(tuple, few)) == exact({i: vs[i] for i in range(3)}, {0: vs[0]}, 4)
    assert topk.top_k(v.limit(0), v.limit(0)).collect() == []


def test_cover_tree_covers():
    pts = np.random.default_rng(1).normal(0, 40, (1500, 6)).round()
    tree = topk.CoverTree(pts)
    for node, rows in enumerate(tree.members):
        far = np.sqrt(((pts[rows] - tree.centre[node]) ** 2).sum(1)).max()
        assert far <= tree.radii[node] + 1e-9
        if tree.children[node] is not None:
            assert sorted(np.concatenate([tree.members[c] for c in tree.children[node]]).tolist()) == sorted(rows.tolist())


def test_pipeline(spark):
    import corpus_pipeline as C
    assert [n for n, _ in C.STAGES] == ["toxicity", "language_id", "ngram_jaccard_join", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    text, columns = {r.doc_id: r.text for r in docs.collect()}, docs.columns
    kept = set(text)
    for name, stage in C.STAGES[:3]:
        before, docs = kept, common.written(stage(spark, docs, SF001), "t")
        assert docs.columns == columns
        rows = [r.doc_id for r in docs.collect()]
        kept = set(rows)
        assert len(rows) == len(kept) and kept <= before
        if name == "toxicity":
            assert not any(label.get(k) == 0 for k in before - kept)
        if name == "ngram_jaccard_join":
            assert kept == {c for _, _, c in brute([(k, text[k]) for k in sorted(before)], 5, 80)}
    packed = C.STAGES[3][1](spark, docs, SF001).collect()
    assert {r.doc_id for r in packed} == kept
    assert {r.doc_id for r in queries.QUERIES["pipeline"](spark, SF001).collect()} == kept


def test_stages_odd(spark, odd, odd_rows, empty):
    """Exactly the rows that a stage has no reason to drop stay, all columns."""
    import corpus_pipeline as C
    stages = dict(C.STAGES)
    plain = lambda df: sorted((tuple(r)[:2] for r in df.collect()), key=repr)
    every = sorted(odd_rows, key=repr)
    for name in ("toxicity", "language_id", "ngram_jaccard_join"):
        assert stages[name](spark, empty, SF001).collect() == []
        assert stages[name](spark, odd, SF001).columns == odd.columns
    # the odd rows hold no toxic clause, and no labelled text to learn a language from
    assert plain(stages["toxicity"](spark, odd, SF001)) == every
    seen, one = set(), []
    for k, t in sorted(every, key=lambda r: (r[0] is None, r[0] or 0)):
        group = shingles(t, 5)
        if not group or group not in seen:
            one.append((k, t))
        seen.add(group)
    assert plain(stages["ngram_jaccard_join"](spark, odd, SF001)) == sorted(one, key=repr)
    packed = stages["best_fit_packing"](spark, odd, SF001).collect()
    assert sorted({r.doc_id for r in packed} - {None}) == sorted({k for k, _ in odd_rows} - {None})
    assert stages["best_fit_packing"](spark, empty, SF001).collect() == []


def test_every_query_is_registered():
    import __spark_entry__ as E
    names = sorted(k for k in E.queries() if k.startswith("op") or k == "pipeline")
    assert sorted(n.split("_")[0] for n in names) == sorted([f"op{i}" for i in range(1, 14)] + ["pipeline"])
