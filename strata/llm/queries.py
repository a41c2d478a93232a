"""Queries over the corpus operators: (spark, sf_dir) -> DataFrame."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, common, idstore, langid, negatives, ngram_join, packing, quality, repair, shuffle, token_counts,
               tokenizing, topk, toxicity, warc)

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


@query
def op1_best_fit_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), tokenizing.vocab_path("word_bpe_49k.json"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


@query
def op2_ngram_ratio_rules(spark, sf_dir):
    return quality.quality_rules(documents(spark, sf_dir), labels(spark, sf_dir), every=True)


@query
def op3_byte_cnn_langid(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir))


@query
def op4_token_counts(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizing.vocab_path("byte_bpe_50k.json"))


@query
def op5_two_pass_shuffle(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    placed = shuffle.write_shuffled(docs, common.scratch(spark, "shuffled"), shards=40)
    text = F.coalesce("text", F.lit(""))
    return placed.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_count_vector_rtree_join(spark, sf_dir):
    return ngram_join.near_duplicates(documents(spark, sf_dir))


@query
def op7_id_store(spark, sf_dir):
    path = common.scratch(spark, "ids")
    idstore.write_store(documents(spark, sf_dir), path, tokenizing.vocab_path("byte_bpe_50k.json"))
    return idstore.read_store(spark, path).drop("ids")


@query
def op8_byte_bpe(spark, sf_dir):
    return bpe.digests(documents(spark, sf_dir), tokenizing.vocab_path("byte_bpe_50k.tiktoken"))


@query
def op9_cover_tree_topk(spark, sf_dir):
    vectors = common.written(topk.integer_vectors(
        spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"), copies=20), "vectors")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


ORACLE["op9_cover_tree_topk"] = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
    FROM (SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v) AS score,
                 row_number() OVER (PARTITION BY q.vec_id
                                    ORDER BY list_dot_product(q.v, d.v) DESC, d.vec_id) AS rank
          FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0)
    WHERE rank <= 20"""


@query
def op10_clause_grammar_toxicity(spark, sf_dir):
    return toxicity.rate(documents(spark, sf_dir), labels(spark, sf_dir))


def relabelled(vectors: DataFrame) -> DataFrame:
    """The contract's labels: moved on by one where vec_id is divisible by 7."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", "embedding", moved.alias("label"))


@query
def op11_hard_negatives(spark, sf_dir):
    vectors = relabelled(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
    return negatives.mine(negatives.usable(vectors), F.col("vec_id") % 100 == 0)


ORACLE["op11_hard_negatives"] = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    a AS (SELECT *, row_number() OVER () AS anchor FROM (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0)),
    pairs AS (
        SELECT a.vec_id AS anchor_id, a.anchor, d.vec_id AS id, a.label = d.label AS same,
               CAST(list_dot_product(a.v, d.v) AS BIGINT) AS score
        FROM a JOIN v d ON a.label <> d.label OR a.vec_id <> d.vec_id),
    p AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place
        FROM pairs WHERE same) WHERE place <= 5)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM (SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score,
                 n.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.id) AS rank
          FROM p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
           AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
    WHERE rank <= 10"""


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage of conversations."""
    spelt = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(spelt("conv_id"), F.lit(":"), spelt("turn")).cast("binary")) % 20
    text = spelt("text")
    hit = rows.select("conv_id", "turn", spelt("role").alias("role"), text.alias("text"), code.alias("code"))
    return (hit.where(F.col("code") != 0).select(
        "conv_id", "turn", F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
        .drop("copy"))


@query
def op12_grammar_repair(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return repair.report(damaged(rows), rows)


def _edit(state: str, cost: str, letter: str, text: str = "''") -> str:
    """SQL: an edit appended to a state {v: cost in 8 digits and audit, t: text}."""
    return (f"CASE WHEN {state} IS NULL THEN NULL ELSE {{'v': lpad(CAST(CAST(left({state}.v, 8) AS BIGINT) + {cost} "
            f"AS VARCHAR), 8, '0') || substr({state}.v, 9) || '{letter}', 't': {state}.t || {text}}} END")


_USER, _ASSISTANT, _OWN = "chr(10) || 'user:'", "chr(10) || 'assistant:'", "chr(10) || role || ':' || text"
_INSERT_U = f"least(s2, {_edit('s0', '2', 'I', _USER)}, {_edit('s1', '2', 'I', _USER)}, {_edit('s3', '2', 'I', _USER)})"
_INSERT_A = f"least(s3, {_edit('i2', '2', 'I', _ASSISTANT)})"
#: crc32 by its bits; the four states of the automaton walked turn by turn
ORACLE["op12_grammar_repair"] = f"""
    WITH RECURSIVE hashed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
                       string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                       lambda c: CAST(ord(c) AS BIGINT))),
                   lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                            lambda x, z: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)))),
                   CAST(4294967295 AS BIGINT)) % 20 AS code
        FROM conversations),
    damaged AS (
        SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
               CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(range(CASE code WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM hashed WHERE code <> 0),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
               rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM damaged),
    faulty AS (
        SELECT *, CASE WHEN core = '' THEN 'blank'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                       WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair FROM placed),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(pos) AS pos,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM faulty GROUP BY conv_id),
    walk AS (
        SELECT conv_id, CAST(0 AS BIGINT) AS pos, {{'v': '00000000', 't': ''}} AS s0, CAST(NULL AS STRUCT(v VARCHAR, t VARCHAR)) AS s1,
               CAST(NULL AS STRUCT(v VARCHAR, t VARCHAR)) AS s2, CAST(NULL AS STRUCT(v VARCHAR, t VARCHAR)) AS s3 FROM counts
        UNION ALL
        SELECT conv_id, pos, {_edit('s0', '3', 'D')},
               CASE WHEN keep AND left(role, 1) = 's' THEN least({_edit('s1', '3', 'D')}, {_edit('s0', 'late', 'K', _OWN)})
                    ELSE {_edit('s1', '3', 'D')} END,
               CASE WHEN keep AND left(role, 1) = 'u' THEN least({_edit('i2', '3', 'D')}, {_edit('before', 'late', 'K', _OWN)},
                                                                 {_edit('before', '2 + late', 'R', _USER + " || text")})
                    WHEN keep THEN least({_edit('i2', '3', 'D')}, {_edit('before', '2 + late', 'R', _USER + " || text")})
                    ELSE {_edit('i2', '3', 'D')} END,
               CASE WHEN keep AND left(role, 1) = 'a' THEN least({_edit('i3', '3', 'D')}, {_edit('i2', 'late', 'K', _OWN)},
                                                                 {_edit('i2', '2 + late', 'R', _ASSISTANT + " || text")})
                    WHEN keep THEN least({_edit('i3', '3', 'D')}, {_edit('i2', '2 + late', 'R', _ASSISTANT + " || text")})
                    ELSE {_edit('i3', '3', 'D')} END
        FROM (SELECT *, least(s0, s1, i3) AS before FROM (SELECT *, {_INSERT_A} AS i3 FROM (
            SELECT w.conv_id, f.pos, w.s0, w.s1, w.s2, w.s3, {_INSERT_U} AS i2, f.role, f.text,
                   f.fault NOT IN ('blank', 'duplicate') AS keep, CASE f.fault WHEN 'truncated' THEN 1 ELSE 0 END AS late
            FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1)))),
    done AS (
        SELECT *, least(s0, {_INSERT_A}) AS best FROM (
            SELECT c.*, s0, s3, {_INSERT_U} AS i2
            FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.pos = w.pos))
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           coalesce(CAST(left(best.v, 8) AS BIGINT), 0) AS cost, coalesce(substr(best.v, 9), '') AS audit,
           sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id"""


@query
def op13_chunked_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    manifest = warc.write_warc(pages, common.scratch(spark, "warc"))
    return warc.read_warc(spark, manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op13_chunked_warc"] = """
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
    r AS (
        SELECT *, row_number() OVER same AS place, first_value(page_id) OVER same AS first
        FROM p WINDOW same AS (PARTITION BY digest ORDER BY page_id NULLS LAST))
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
           CASE WHEN n >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND place > 1 THEN first END AS refers_to
    FROM r"""


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)

