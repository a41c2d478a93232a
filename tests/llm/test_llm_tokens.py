"""Packing, token counts, id store and byte BPE against the libraries."""
import hashlib
import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from llm_fixtures import empty, odd, odd_rows, small  # noqa: F401 (fixtures)
from llm_fixtures import table as table_of
from hypothesis import given, settings
from hypothesis import strategies as st
from strata.llm import bpe, common, idstore, packing, queries, token_counts, tokenizing

BYTE, WORD, RANKS = (tokenizing.vocab_path(n) for n in
                     ("byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_50k.tiktoken"))


def library(path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


PARTS = ["a", "É", "ß", "1", "²", "_", ".", ",", "'s", "'", "!", "%", " ", "  ", "\n", "\t", " ", "\x1c",
         "<|endoftext|>", "中", "word", "\r\n", "é", "Σ", "ς", "don't", "İx", "…", "naïve"]


@pytest.mark.parametrize("path,byte_level", [(BYTE, True), (WORD, False)])
def test_cut_texts_have_the_ids_of_whole_texts(path, byte_level):
    enc, whole, rnd = tokenizing.Encoder(path, byte_level=byte_level), library(path), random.Random(1)
    for _ in range(4000):
        t = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14)))
        assert b"".join(enc.values(t)) == tokenizing.id_bytes(whole(t)), repr(t)


def test_pieces_survive_a_full_cache(monkeypatch):
    monkeypatch.setattr(tokenizing, "CACHE", 3)
    enc, whole = tokenizing.Encoder(BYTE), library(BYTE)
    for t in ("a b c d e f, g. h", "a b c x y z", "f g h a b") * 3:
        assert b"".join(enc.values(t)) == tokenizing.id_bytes(whole(t))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.lists(st.tuples(st.integers(1, 60), st.integers(1, 40)), max_size=40))
def test_packing_plan_places_each_piece_once(capacity, pairs):
    want = defaultdict(int)
    for length, n in pairs:
        want[min(length, capacity)] += n
    segments, sequences = packing.plan_segments(want, capacity)
    bins, got = defaultdict(list), defaultdict(int)
    for length, first, n, at, offset in segments:
        assert first == got[length]
        got[length] += n
        for i in range(n):
            bins[at + i].append((offset, length))
    assert dict(got) == {k: v for k, v in want.items() if v}
    assert sorted(bins) == list(range(sequences))
    for found in bins.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= capacity
    # any-fit: two sequences cannot both be at most half full
    assert sum(sum(n for _, n in b) * 2 <= capacity for b in bins.values()) <= 1


def test_dominance_fixes_perfect_pairs():
    segments, sequences = packing.plan_segments({1500: 3, 548: 3, 2048: 2}, 2048)
    assert sequences == 5


def check_packing(rows, docs):
    whole = library(WORD)
    want = []
    for k, t in docs:
        ids = array("I", [*whole(t), 0])
        for i in range(0, len(ids), 2048):
            part = ids[i:i + 2048]
            want.append((k, i // 2048, i, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=key) == sorted(want, key=key)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        end = 0
        for offset, length in sorted(b):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(r.length for r in rows)
    assert len(bins) <= 1.05 * total / 2048 + 2


def test_op1(spark, small):
    check_packing(queries.QUERIES["op1_best_fit_packing"](spark, SF001).collect(), [r[:2] for r in small])


def test_packing_odd(odd, odd_rows, empty):
    check_packing(packing.pack(odd, WORD).collect(), odd_rows)
    assert packing.pack(empty, WORD).collect() == []


def test_packing_keeps_ids(odd):
    got = packing.pack(odd.where("doc_id = 10"), WORD, with_ids=True).collect()
    assert len(got) == 1 and zlib.crc32(got[0].ids) == got[0].ids_crc32


def check_counts(rows, docs):
    whole = library(BYTE)
    want = [(k, len((t or "").encode()), n := len(whole(t)), n > 1024) for k, t in docs]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_op4(spark, small):
    check_counts(queries.QUERIES["op4_token_counts"](spark, SF001).collect(), [r[:2] for r in small])


@pytest.mark.parametrize("table", [1, 50])
def test_counts_odd(odd, odd_rows, empty, table):
    check_counts(token_counts.count_tokens(odd, BYTE, table=table).collect(), odd_rows)
    assert token_counts.count_tokens(empty, BYTE).collect() == []


def test_the_table_is_fitted_on_a_bounded_sample(spark, small, monkeypatch):
    """Counts are those of whole encoding whatever rows the sample drew."""
    path = tokenizing.vocab_path("byte_bpe_50k.json")
    docs = table_of(spark, small)
    full = sum(len((t or "").encode()) for _, t, _ in small)
    few = token_counts.sampled(docs, full // 5)
    drawn = sum(len((r.text or "").encode()) for r in few.collect())
    assert full // 12 <= drawn <= full // 2 and token_counts.sampled(docs, full).count() == len(small)
    want = sorted(map(tuple, token_counts.count_tokens(docs, path).collect()))
    monkeypatch.setattr(token_counts, "SAMPLE", full // 5)
    assert sorted(map(tuple, token_counts.count_tokens(docs, path).collect())) == want


def test_length_table():
    h = np.array([5, 1, 9], np.uint64)
    t = token_counts.LengthTable(h, np.array([2, 3, 4], np.uint8))
    assert t.get_all(np.array([9, 2, 5, 1], np.uint64)).tolist() == [4, 0, 2, 3]
    assert token_counts.LengthTable(h[:0], np.zeros(0, np.uint8)).get_all(h).tolist() == [0, 0, 0]


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = np.unique(np.random.default_rng(3).integers(-2**63, 2**63 - 1, 20_000))
    ph = idstore.PerfectHash.build(keys)
    assert sorted(ph.find(keys).tolist()) == list(range(len(keys)))
    assert len(idstore.PerfectHash.build(keys[:0]).find(keys)) == len(keys)


def check_store(rows, docs):
    whole = library(BYTE)
    want, start = [], 0
    for k, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        raw = array("I", [*whole(t), 0])
        want.append((k, start, len(raw), zlib.crc32(raw.tobytes())))
        start += len(raw)
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows], key=lambda r: r[1]) == want


def test_op7(spark, small):
    check_store(queries.QUERIES["op7_id_store"](spark, SF001).collect(), [r[:2] for r in small])


def test_store_odd(spark, odd, odd_rows, empty):
    path = common.scratch(spark, "store")
    idstore.write_store(odd, path, BYTE, shards=3)
    check_store(idstore.read_store(spark, path).collect(), odd_rows)
    keys = spark.createDataFrame([(4,), (3,), (99,), (None,)], "doc_id long")
    got = idstore.lookup(spark, path, keys).collect()
    assert sorted((r.doc_id is not None, r.doc_id) for r in got) == \
        [(False, None)] * 2 + [(True, 3)] * 2 + [(True, 4)] * 3
    path = common.scratch(spark, "store")
    idstore.write_store(empty, path, BYTE)
    assert idstore.read_store(spark, path).collect() == []


def check_bpe(rows, docs):
    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=tokenizing.BYTE_PATTERN, mergeable_ranks=bpe.read_ranks(RANKS),
                            special_tokens={})
    want = []
    for k, t in docs:
        raw = (t or "").encode()
        ids = array("I", enc.encode_ordinary(t or ""))
        want.append((k, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest()))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_op8(spark, small):
    check_bpe(queries.QUERIES["op8_byte_bpe"](spark, SF001).collect(), [r[:2] for r in small])


def test_bpe_odd(odd, odd_rows, empty, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE", 5)
    check_bpe(bpe.decode(bpe.encode(odd, RANKS, table=5), RANKS)
              .selectExpr("doc_id", "octet_length(ids) div 4", "sha2(ids, 256)", "sha2(bytes, 256)").collect(), odd_rows)
    assert bpe.digests(empty, RANKS).collect() == []


def test_rows_that_share_a_key_go_over_several_shards(spark, scratch):
    """A third of the rows without key, a third under one: no shard above twice
    the median, every row there, found by its key."""
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"text number {i} " * 5) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = tokenizing.vocab_path("byte_bpe_50k.json")
    sizes = sorted(r.docs for r in idstore.write_store(docs, f"{scratch}/store", path, shards=6).collect())
    assert sum(sizes) == 600 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    stored = idstore.read_store(spark, f"{scratch}/store").collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in stored) == sorted((k is not None, k or 0) for k, _ in rows)
    found = idstore.lookup(spark, f"{scratch}/store", spark.createDataFrame([(5,), (4,), (2,)], "doc_id long")).collect()
    assert sorted(r.doc_id for r in found) == [2] + [5] * 201  # row 5 has it too


def test_counts_of_words_are_whole(spark, monkeypatch):
    """A task that holds few words passes their counts on, and forgets none."""
    import regex
    monkeypatch.setattr(bpe, "HELD", 20)
    texts = [" ".join(f"w{chr(97 + i * k % 23)}{chr(97 + k % 19)}" for k in range(30)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    want: dict = {}
    for w in (w for t in texts for w in regex.findall(tokenizing.BYTE_PATTERN, t)):
        want[w.encode()] = want.get(w.encode(), 0) + 1
    assert {bytes(r.word): r.n for r in bpe.frequent_words(docs).collect()} == want


def test_odd_texts_are_told_by_pairs():
    """Every pair of Latin-1 characters, at even and odd places, and others."""
    for a in range(256):
        for b in range(256):
            if a < 48 or 123 <= a < 192 or b < 48 or 90 < b < 192:
                t = "word" * 16 + chr(a) + chr(b) + "word" * (1 + a % 2)
                assert tokenizing.is_odd(t) == tokenizing.is_odd("x" + t) == tokenizing._odd(t)
    assert tokenizing.is_odd("\u4e2d" * 70 + "\u3000") and not tokenizing.is_odd("\u4e2d" * 70 + " x")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PARTS), max_size=12).map("".join),
                          st.lists(st.sampled_from(["word", "Naïve", "a1"]), max_size=9).map(" ".join)), max_size=8))
def test_a_batch_has_the_ids_of_its_texts(texts):
    ids, sizes = tokenizing.encoder(BYTE).batch(texts)
    want = [library(BYTE)(t) for t in texts]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_a_batch_looks_each_distinct_piece_up_once():
    texts = [f"Some words, and the words of text {i}.\nSome more words" for i in "abc"] * 40 + ["__two  odd__"] * 40
    enc = tokenizing.Encoder(BYTE)
    asked = []
    for cache in (enc.bare, enc.spaced):
        get = cache.get_all
        cache.get_all = lambda pieces, get=get: asked.extend(pieces) or get(pieces)
    ids, sizes = enc.batch(texts)
    assert len(asked) < 30 and sizes.sum() == len(ids)
    runs = list(tokenizing.together(["x" * (tokenizing.TOGETHER // 2)] * 7 + [None]))
    assert [hi for _, hi in runs] == [lo for lo, _ in runs[1:]] + [8] and max(hi - lo for lo, hi in runs) == 3


def test_a_pair_is_looked_up_by_numbers():
    """Every pair of tokens that joins to one has its rank; other pairs get no
    number of a rank."""
    ranks = bpe.read_ranks(RANKS)
    pairs = bpe.merges(ranks)
    shift, slots, modulus = bpe.rank_slots(ranks)
    other = np.random.default_rng(1).integers(0, max(ranks.values()) + 2, (50_000, 2))
    joins = set(map(tuple, pairs[:, :2].tolist()))
    for ab, want in ((pairs[:, :2], pairs[:, 2]), (other, None)):
        number = (ab[:, 0] << bpe.BITS) + ab[:, 1]
        at = shift[number % len(shift)] + number % modulus
        got = np.where(at < len(slots), slots[np.minimum(at, len(slots) - 1)] ^ (number << bpe.BITS), 1 << bpe.BITS)
        if want is None:
            assert all((g < 1 << bpe.BITS) == (tuple(p) in joins) for g, p in zip(got.tolist(), ab.tolist()))
        else:
            assert (got == want).all()


def test_frequent_words_are_chosen_on_a_bounded_sample(spark, small, monkeypatch):
    """The same ids whatever the sample; decoded beside, as by ``decode``."""
    docs = table_of(spark, [r[:2] for r in small])
    seen = []
    words = bpe.frequent_words
    monkeypatch.setattr(bpe, "frequent_words", lambda docs, n: seen.append(docs.count()) or words(docs, n))
    monkeypatch.setattr(bpe, "SAMPLE", sum(len((r[1] or "").encode()) for r in small) // 5)
    check_bpe(bpe.digests(docs, RANKS).collect(), [r[:2] for r in small])
    assert 0 < seen[0] < len(small) // 2


def test_plans_do_not_print_the_rank_map(spark, small):
    """The driver keeps descriptions of plans; the map has 190,000 numbers."""
    docs = table_of(spark, [r[:2] for r in small[:20]])
    plan = bpe.digests(docs, RANKS)._jdf.queryExecution().toString()
    assert len(plan) < 200_000


def test_fold_of_words_of_all_lengths(spark):
    """Up to ``LONGEST`` bytes, of any bytes, as the library joins them."""
    rnd = random.Random(5)
    parts = [b"en", b"er", b"the", b" ", b"aa", b"ing", "ß".encode(), "中".encode(), b"\xff", b"\x00", b"7", b"''"]
    words = [b"".join(rnd.choice(parts) for _ in range(rnd.randint(1, 30)))[:n] for n in range(1, bpe.LONGEST + 1)
             for _ in range(8)] + [b"a" * bpe.LONGEST, b"\xff" * bpe.LONGEST, *(bytes([i]) for i in range(256))]
    rows = bpe.RankMap(spark, RANKS).encode(spark.createDataFrame([(words,), ([],)], "words array<binary>"), "words")
    got = {len(r.words): r.ids for r in rows.collect()}
    library = bpe._library(RANKS)
    assert got[0] == [] and got[len(words)] == [library.encode_single_piece(w) for w in words]


def test_words_are_found_in_the_table():
    words = [b"", b"some", "über".encode(), b"\xff\x00", b"words"]
    ids = [[], [1], [2, 3], [70_000, 5, 6], [9]]
    for n in (0, 1, 5):
        found = bpe.WordTable(pa.array(words[:n], pa.binary()), pa.array(ids[:n], pa.list_(pa.int32()))).find([*words, b"none"])
        assert found == [array("i", x).tobytes() for x in ids[:n]] + [None] * (6 - n)
