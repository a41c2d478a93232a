"""Hard negatives, conversation repair and WARC archives against SQL, brute
force and round trips."""
import gzip
import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F
from strata.llm import negatives, queries, repair, warc

SF = "/root/testdata/sf0.001"


def sql_rows(path, name, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return sorted(con.execute(queries.ORACLE[name]).fetchall(), key=repr)


# -- hard negatives ----------------------------------------------------------

def mined(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
                   for r in df.collect()), key=repr)


def test_negatives_equal_sql(spark):
    got = mined(queries.QUERIES["op11_hard_negatives"](spark, SF))
    assert got == sql_rows(f"{SF}/embeddings.parquet", "op11_hard_negatives", "embeddings") and got


@pytest.mark.parametrize("block", [8192, 7])
def test_negatives_odd_rows(spark, scratch, monkeypatch, block):
    """Nulls, repeated rows, shared keys, ties, a key that a third of the rows
    share, other columns, an empty table."""
    monkeypatch.setattr(negatives, "ROW_BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", block)
    rnd = random.Random(block)
    vector = lambda: [rnd.choice([-1.0, -0.25, 0.0, 0.5, 1.0, 2.0]) for _ in range(4)]
    rows = [(i * 25, vector(), rnd.randrange(3), "x") for i in range(60)]
    rows += [(rnd.choice([100, 125, 700]), vector(), rnd.randrange(3), "y") for _ in range(20)] + [rows[8]] * 30
    rows += [rows[4]] * 3 + [(13, [0.0] * 4, 1, "z")] * 25
    rows += [(100, None, 1, ""), (200, [1.0, None, 0.0, 0.0], 1, ""), (None, [1.0] * 4, 1, ""), (300, [1.0] * 4, None, ""),
             (400, [float("nan")] * 4, 1, ""), (500, [float("inf"), 0.0, 0.0, 0.0], 2, "")]
    path = f"{scratch}/embeddings.parquet"
    schema = "vec_id long, embedding array<float>, label int, anchor string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    got = mined(queries.QUERIES["op11_hard_negatives"](spark, scratch))
    assert got == sql_rows(f"{path}/*.parquet", "op11_hard_negatives", "embeddings") and len(got) > 50
    none = queries.relabelled(spark.createDataFrame([], schema))
    assert negatives.mine(negatives.usable(none), F.lit(True)).collect() == []


# -- conversation repair -----------------------------------------------------

def damage(rows):
    """The contract's damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        spelt = [" " if x is None else str(x) for x in (conv, turn)]
        code = zlib.crc32(":".join(spelt).encode()) % 20
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def brute(rows, convs):
    """Reports of all conversations by a plain walk over prefixes."""
    out = {}
    for conv in convs:
        mine = sorted((r for r in rows if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, _, role, text in mine:
            core = text.strip(repair.WHITE)
            faults.append("blank" if not core else "duplicate" if (role, text) in seen
                          else "truncated" if core[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        best = {"": (0, "", "")}  # last two initials -> (cost, audit, repaired); grows by the accepted prefixes

        def step(state, initial):
            return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state].get(initial)

        def add(into, state, entry):
            if state is not None and (state not in into or entry[:2] < into[state][:2]):
                into[state] = entry

        def inserted(states):
            for _ in range(3):
                for s, (c, a, t) in list(states.items()):
                    for initial, role in (("u", "user"), ("a", "assistant")):
                        add(states, step(s, initial), (c + 2, a + "I", t + f"\n{role}:"))
            return states

        for (_, _, role, text), fault in zip(mine, faults):
            now = {}
            for s, (c, a, t) in inserted(best).items():
                add(now, s, (c + 3, a + "D", t))
                if fault not in ("blank", "duplicate"):
                    more = fault == "truncated"
                    add(now, step(s, role[:1]) if role[:1] in ("s", "u", "a") else None, (c + more, a + "K", t + f"\n{role}:{text}"))
                    for initial, name in (("u", "user"), ("a", "assistant")):
                        add(now, step(s, initial), (c + 2 + more, a + "R", t + f"\n{name}:{text}"))
            best = now
        cost, audit, text = min(v for s, v in inserted(best).items() if s in ("", "a"))
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost,
                     audit, hashlib.sha256(text[1:].encode()).hexdigest())
    return out


def reports(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in df.collect()}


def test_repair_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    got = reports(queries.QUERIES["op12_grammar_repair"](spark, SF))
    assert got == brute(damage(rows), {r[0] for r in rows})
    assert any(len(set(v[6])) > 2 for v in got.values())


def test_sql_equals_brute_force():
    """The query's SQL on odd rows: the brute force and it check one another."""
    con, rows = duckdb.connect(), odd_turns(5)
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = {r[0]: r[1:] for r in con.execute(queries.ORACLE["op12_grammar_repair"]).fetchall()}
    assert got == brute(damage(rows), {r[0] for r in rows})


def odd_turns(seed, n=60):
    rnd = random.Random(seed)
    texts = ["Fine.", "cut off", " \t", "", None, "Yes!  ", "no, \n", "é.", "word " * 300 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u"]
    rows = [(c, None if rnd.random() < .05 else t, rnd.choice(roles[:rnd.choice([2, 5, 9])]), rnd.choice(texts))
            for c in range(n) for t in rnd.sample(range(12), rnd.randrange(1, 9))]
    rows += [(None, t, rnd.choice(roles), rnd.choice(texts)) for t in range(150)]  # rows without conversation
    rows += [(n, 1, "user", "same")] * 40 + [(n + 1, None, None, None)] * 3
    rows += [(n + 2, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(400)]  # a long one
    return rows


@pytest.mark.parametrize("size", [4096, 5])
def test_repair_odd_rows(spark, size):
    """Nulls, ties, repeated turns, unknown roles, long conversations in small
    pieces, an empty table."""
    rows = odd_turns(size)
    schema = "conv_id long, turn long, role string, text string, place string, key0 string"
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], schema).repartition(5)
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = brute(clean, {r[0] for r in rows})
    got = reports(repair.report(df, size=size))
    assert got == want
    turns = repair.repaired(df, size=size).orderBy("conv_id", "seat").collect()
    for conv, r in want.items():
        lines = "\n".join(f"{t.role}:{t.text}" for t in turns if t.conv_id == conv)
        assert hashlib.sha256(lines.encode()).hexdigest() == r[7]
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[0] for t in turns if t.conv_id == conv))
    none = spark.createDataFrame([], schema)
    assert repair.report(none, none).collect() == [] and repair.repaired(none).collect() == []
    gone = repair.report(none, df.where("conv_id = 0")).collect()
    assert [tuple(r) for r in gone] == [(0, 0, 0, 0, 0, 0, 0, "", repair.EMPTY_HASH)]


def test_grammar_shares_rules(spark):
    pieces = spark.createDataFrame([("ua" * n,) for n in range(1, 60)], "symbols string")
    grammar = repair.re_pair(pieces)
    assert any(len(grammar.spelt[s]) >= 8 for s, _, _ in grammar.rules)
    rows = pieces.withColumn("word", grammar.compressed(F.col("symbols"))).collect()
    assert all(grammar.spell(r.word) == r.symbols for r in rows)
    assert sum(len(r.word) for r in rows) * 4 < sum(len(r.symbols) for r in rows)
    plain = repair.Grammar([])
    for r in rows[:20]:
        want, got = plain.product(r.symbols), grammar.product(r.word)
        spelt = lambda m: [[e and (e[0], repair.text_of(e[1])) for e in row] for row in m]
        assert spelt(got) == spelt(want)


# -- WARC --------------------------------------------------------------------

def page_rows(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_warc_equals_sql(spark):
    got = page_rows(queries.QUERIES["op13_chunked_warc"](spark, SF))
    assert got == sql_rows(f"{SF}/pages.parquet", "op13_chunked_warc", "pages") and got


def odd_pages():
    rnd = random.Random(13)
    big = "".join(rnd.choice("abcé 中\n") for _ in range(700_000))
    texts = [None, "", "short", "short", "x" * 99, "x" * 99, "x" * 100, "x" * 100, big, "WARC/1.1\r\n\r\n" * 40]
    rows = [(i, f"http://a/{i}?q=%0A\r\nX: y", t) for i, t in enumerate(texts)]
    rows += [(None, None, "x" * 100), (None, "u", "no key " * 40), (None, "v", "no key " * 40), rows[9], rows[9]]
    rows += [(5, "w", big)] + [(1000 + i, "hot", "one text on many pages " * 9) for i in range(60)]
    return rows


@pytest.mark.parametrize("size", [warc.CHUNK, 1000])
def test_warc_round_trip(spark, scratch, monkeypatch, size):
    """Nulls, empty and long payloads in chunks, equal payloads, rows that
    repeat, an empty table, several archives."""
    monkeypatch.setattr(warc, "ARCHIVE", 5000)
    rows = odd_pages()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, record string, chunk int")
    path = f"{scratch}/pages.parquet"
    df.repartition(3).write.parquet(path)
    manifest = warc.write_warc(spark.read.parquet(path), f"{scratch}/archives", size=size)
    got = page_rows(warc.read_warc(spark, manifest, payloads=False))
    assert got == sql_rows(f"{path}/*.parquet", "op13_chunked_warc", "pages")
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) and manifest.count() > 1

    chunks = warc.read_warc(spark, manifest, size=size)
    read: dict = {}
    for r in sorted(chunks.collect(), key=lambda r: (r.record_id, r.chunk)):
        assert len(r.payload) <= size and r.upto == len(read.setdefault(r.record_id, [r, b""])[1]) + len(r.payload)
        read[r.record_id][1] += bytes(r.payload)
        assert r.digest == hashlib.sha256(read[r.record_id][1]).hexdigest()
    full = {k: v[1] if v[0].record_type == "response" else read[v[0].refers_to_id][1] for k, v in read.items()}
    assert sorted((v[0].page_id, v[0].url, full[k].decode()) for k, v in read.items() if v[0].page_id is not None) == sorted(
        (p, u, t or "") for p, u, t in rows if p is not None)
    none = df.limit(0)
    assert warc.read_warc(spark, warc.write_warc(none, f"{scratch}/none")).collect() == []


def test_warc_damage_is_seen(spark, scratch):
    pages = spark.createDataFrame([(1, "u", "some page " * 50)], "page_id long, url string, html string")
    manifest = warc.write_warc(pages, f"{scratch}/archives")
    name = manifest.first().file
    raw = gzip.open(name).read()
    with gzip.open(name, "wb") as f:
        f.write(raw.replace(b"some page some", b"some page sume"))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_warc(spark, manifest).collect()
