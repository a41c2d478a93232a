"""Near duplicates in the pipeline's stage: five words, 0.8."""
import random

import numpy as np
import pytest
from conftest import SF001
from llm_fixtures import small, table  # noqa: F401 (fixtures)
from strata.llm import ngram_join


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)] if w else [])


def groups(texts, n=5, percent=80):
    """Position -> first position of its group, by comparing all pairs."""
    sets, up = [shingles(t, n) for t in texts], list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if a and sets[j] and 100 * o >= percent * (len(a) + len(sets[j]) - o):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def stage(spark, docs):
    import corpus_pipeline as C
    return dict(C.STAGES)["ngram_jaccard_join"](spark, docs, SF001)


def words(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def test_stage_links_two_replaced_words_of_a_hundred(spark):
    text = words(100, 1)
    near = [*text[:30], "other", *text[31:70], "another", *text[71:]]
    docs = table(spark, [(1, " ".join(text)), (2, " ".join(near))])
    assert [r.doc_id for r in stage(spark, docs).collect()] == [1]
    # op6 keeps three words and 0.9
    assert {r.component_id for r in ngram_join.near_duplicates(docs).collect()} == {1, 2}


@pytest.mark.parametrize("tile", [2048, 4])
def test_stage_equals_brute_force(spark, small, monkeypatch, tile):  # noqa: F811
    monkeypatch.setattr(ngram_join, "TILE", tile)
    rnd, texts = random.Random(tile), [t for _, t, _ in small]
    for size in (5, 7, 8, 9, 13, 24, 60, 121, 300):
        text = words(size, size)
        for _ in range(8):
            texts.append(" ".join(text))
            for _ in range(rnd.randint(0, max(1, size // 40))):
                text[rnd.randrange(size)] = "".join(rnd.choice("abcdefgh") for _ in range(6))
    want = groups(texts)
    assert sum(i != w for i, w in enumerate(want)) > sum(i != w for i, w in enumerate(groups(texts, 3, 90)))
    docs = table(spark, list(enumerate(texts))).repartition(3)
    assert sorted(r.doc_id for r in stage(spark, docs).collect()) == sorted(set(want))


def test_stage_blocks_leave_one_equal():
    rnd, rule, linked = np.random.default_rng(4), ngram_join.STAGE, 0
    for n in [4, 5, 6, 7, 8, 9, 12, 13, 16, 20, 45, 90, 200, 777]:
        for _ in range(40):
            a = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64))
            grow, drop = rnd.integers(0, n // 4 + 1, 2)
            b = np.unique(np.concatenate([a[drop:], rnd.integers(0, 2**63, grow).astype(np.uint64)]))
            if ngram_join.linked(a, b, rule):
                linked += 1
                assert np.intersect1d(ngram_join.block_keys(a, rule), ngram_join.block_keys(b, rule)).size
    assert linked > 50


def test_unlike_sets_share_no_empty_blocks():
    rnd, rule = np.random.default_rng(6), ngram_join.STAGE
    keys = [ngram_join.block_keys(np.unique(rnd.integers(0, 2**63, 1000).astype(np.uint64)), rule) for _ in range(200)]
    assert len(np.unique(np.concatenate(keys))) == sum(map(len, keys))


def test_rows_of_one_key_are_kept_by_text(spark):
    """Unlike texts under one key are each the only row of their group."""
    a, b, c = (" ".join(words(40, s)) for s in (11, 12, 13))
    near_b = f"{b} more"
    rows = [(3, a), (3, b), (3, b), (3, c), (2, near_b), (7, a), (None, a), (None, "no key here"), (5, None), (5, " \n"),
            (5, ""), (None, None), (3, None)]
    docs = table(spark, rows).repartition(4)
    got = sorted(((r.doc_id, r.text) for r in stage(spark, docs).collect()), key=repr)
    assert got == sorted([(3, a), (2, near_b), (3, c), (None, "no key here"), (5, None), (5, " \n"), (5, ""),
                          (None, None), (3, None)], key=repr)


def test_one_member_row_for_each_class(spark, monkeypatch):
    """A key with many texts and repeated rows: a class enters its tile once."""
    rows = []
    for size in (60, 61, 62):
        text = words(size, size)
        for i in range(6):
            rows += [(3, " ".join(text))] * 5 + [(100 + i, " ".join(text))]
            text[7 * i] = f"new{i}"
    seen, write = {}, ngram_join.common.written

    def written(df, name):
        out = write(df, name)
        if name == "members":  # it goes when the tiles are joined
            seen[name] = [r.node for r in out.collect()]
        return out
    monkeypatch.setattr(ngram_join.common, "written", written)
    got = ngram_join.near_duplicates(table(spark, rows).repartition(4), ngram_join.STAGE).collect()
    assert {r.component_id for r in got} == {3} and len(got) == len(rows)
    nodes = seen["members"]
    assert len(nodes) == len(set(nodes)) == 18


def test_rows_without_key_link(spark):
    """A near copy without key, and one that ties two texts which do not link."""
    text, pair = words(100, 31), words(50, 32)
    bridge, end = list(text), list(text)
    bridge[20] = end[20] = "other"
    end[70] = "another"
    rows = [(8, " ".join(text)), (None, " ".join(bridge)), (9, " ".join(end)),
            (4, " ".join(pair)), (None, " ".join([*pair, "more"])), (None, " ".join(words(30, 33)))]
    got = ngram_join.near_duplicates(table(spark, rows).repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(8, 98, 8), (None, 98, 8), (9, 98, 8), (4, 48, 4), (None, 49, 4),
                                                        (None, 28, None)], key=repr)


def test_a_passage_that_many_share_does_not_multiply_rows(spark, monkeypatch):
    """Two hundred texts in one neighbourhood, of which few link: they are not
    copied to every tile."""
    monkeypatch.setattr(ngram_join, "TILE", 10)
    common_part, rows = words(60, 41), []
    for i in range(200):
        text = [*common_part, *words(60, 1000 + i)]
        rows.append((i, " ".join(text)))
        if i % 20 == 0:
            text[100] = "other"
            rows.append((500 + i, " ".join(text)))
    dealt, tiles = [], ngram_join._tiles
    monkeypatch.setattr(ngram_join, "_tiles", lambda m, rule: (dealt.append(m.count()), tiles(m, rule))[1])
    got = ngram_join.near_duplicates(table(spark, rows).repartition(3), ngram_join.STAGE).collect()
    assert {r.doc_id: r.component_id for r in got} == {k: k - 500 if k >= 500 else k for k, _ in rows}
    assert sum(dealt) <= 2 * len(rows)


def test_linked_sets_share_one_of_their_rarest_shingles():
    rnd, rule, linked = np.random.default_rng(8), ngram_join.STAGE, 0
    base = np.unique(rnd.integers(0, 2**62, 300))
    for size in (4, 5, 9, 40, 250):
        sets = [np.unique(np.concatenate([rnd.choice(base, size, replace=False), rnd.integers(0, 2**62, k % 9)]))
                if k % 3 else np.unique(np.append(base[:size], rnd.integers(0, 2**62, k % 7))) for k in range(24)]
        keys, ids = np.concatenate(sets), np.repeat(np.arange(24), list(map(len, sets)))
        some = [np.frombuffer(x, np.int64).reshape(3, -1) for _, x in ngram_join._bundled(keys, ids, 1)]
        k, c = ngram_join._rarest(some[0][0], some[0][1], some[0][2], np.arange(24), np.array(list(map(len, sets))), rule)
        for i in range(24):
            for j in range(i):
                if ngram_join.linked(sets[i].astype(np.uint64), sets[j].astype(np.uint64), rule):
                    linked += 1
                    assert np.intersect1d(k[c == i], k[c == j]).size
    assert linked > 50


def edited(n, copies, seed):
    """A text and near copies of it, each with its own few other words."""
    rnd, text = random.Random(seed), words(n, seed)
    yield " ".join(text)
    for _ in range(copies):
        own = list(text)
        for _ in range(n // 60):
            own[rnd.randrange(n)] = "".join(rnd.choice("abcdefgh") for _ in range(6))
        yield " ".join(own)


def test_ties_do_not_grow_with_the_number_of_buckets(spark, monkeypatch):
    """Near copies share blocks in every bucket, but are not tied in each. The
    neighbourhoods are those of all shared blocks, and so are the groups."""
    texts = [t for seed in range(12) for t in edited(600, 5, 50 + seed)] + [" ".join(words(3, s)) for s in range(9)]
    docs, rule = table(spark, list(enumerate(texts))).repartition(3), ngram_join.STAGE
    sets = [ngram_join.Shingler(rule).hashes(t) for t in texts]
    ids, keys = [ngram_join.set_id(h) for h in sets], [set(ngram_join.block_keys(h, rule).tolist()) for h in sets]
    up = {i: i for i in ids}
    for a, x in zip(ids, keys):
        for b, y in zip(ids, keys):
            if x & y:
                low, high = sorted((up[a], up[b]))
                up = {i: low if v == high else v for i, v in up.items()}
    want = {(i, v) for i, v in up.items() if i in up.values() and list(up.values()).count(v) > 1 or i != v}
    rows, made = {}, ngram_join.components
    monkeypatch.setattr(ngram_join, "components", lambda found: made(rows.setdefault(ngram_join.BLOCK_KEYS, found)))
    n_keys = sum(map(len, keys))
    for size in (n_keys, n_keys // 60):
        monkeypatch.setattr(ngram_join, "BLOCK_KEYS", size)
        assert {tuple(r) for r in ngram_join.neighbourhoods(docs, n_keys, rule).collect()} == want
    few, many = (rows[k].count() for k in sorted(rows, reverse=True))
    assert few >= 60 and many <= 8 * len(texts)


@pytest.mark.parametrize("seed", range(6))
def test_marks_and_ties_connect_what_keys_do(seed):
    rnd = np.random.default_rng(seed)
    ids = np.unique(rnd.integers(-99, 99, 30))
    marked = rnd.integers(0, 40, (len(ids), 2)).astype(np.uint64)
    ties = np.unique(rnd.choice(ids, (25, 2)), axis=0)

    def parts(links):
        up = {i: i for i in ids.tolist()}
        for row, own in zip(ids.tolist(), marked.tolist()):
            links = links + [(row, other) for other, m in zip(ids.tolist(), marked.tolist()) if set(own) & set(m)]
        for a, b in links:
            up = {i: up[a] if v == up[b] else v for i, v in up.items()}
        return {frozenset(i for i in up if up[i] == v) for v in up.values()}
    new = ngram_join._spanning(ties, ids, marked).tolist()
    assert parts(list(map(tuple, new))) == parts(list(map(tuple, ties.tolist())))
    assert len(new) < len(ids)
