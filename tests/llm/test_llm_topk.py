"""Top-k search with rows that share a key, against the query's SQL."""
import random

import duckdb
import pytest
from strata.llm import queries, topk


@pytest.mark.parametrize("block", [8192, 7])
def test_rows_of_one_key_are_candidates_each(spark, scratch, monkeypatch, block):
    monkeypatch.setattr(topk, "DATA_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    rnd = random.Random(block)
    vector = lambda: [rnd.choice([-1.0, -0.25, 0.0, 0.5, 1.0, 2.0]) for _ in range(4)]
    rows = [(i, vector()) for i in range(45)]
    rows += [(rnd.choice([3, 20, 40, 41]), vector()) for _ in range(40)] + [rows[7]] * 30 + [rows[0]] * 2
    path = f"{scratch}/embeddings.parquet"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    want = con.execute(queries.ORACLE["op9_cover_tree_topk"]).fetchall()
    got = queries.QUERIES["op9_cover_tree_topk"](spark, scratch).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)


def test_far_blocks_are_not_copied(spark, monkeypatch):
    """Clustered vectors: rows go to a few of the blocks only, and the result
    is that of brute force."""
    monkeypatch.setattr(topk, "DATA_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 10)
    rnd = random.Random(5)
    centres = [[rnd.choice([-60, 60]) for _ in range(12)] for _ in range(12)]
    rows = [(i, [c + rnd.randint(-2, 2) for c in centres[i % 12]]) for i in range(1200)]
    v = spark.createDataFrame(rows, "vec_id long, v array<long>")
    left, right = topk.pairs_to_walk(v, v.where("vec_id % 20 = 0"), 5)
    d_blocks, q_blocks = left.select("d_block").distinct().count(), left.select("q_block").distinct().count()
    print("query rows", left.count(), "of", 60 * d_blocks, "data rows", right.count(), "of", 1200 * q_blocks)
    assert left.count() < 60 * d_blocks / 2 and right.count() < 1200 * q_blocks / 2
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(v, v.where("vec_id % 20 = 0"), 5).collect())
    want = []
    for q, a in rows[::20]:
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q)[:5]
        want += [(q, n, i, -x) for n, (x, i) in enumerate(best, 1)]
    assert got == sorted(want)
