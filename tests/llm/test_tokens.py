import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from souk.llm import token_counts, token_files  # noqa: E402

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "é", "Don't", "'s", ",", ".", "<|endoftext|>", "</s>", "<s>", "中文", "9", "$$", "\r\n",
        "\n ", " \n", "\x85", " ", "▁", ""]


def texts(n):
    rng = random.Random(6)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 16))) for _ in range(n)]


def test_units_give_the_ids_of_whole_texts():
    encoder = token_files.Encoder(JSON)
    some = texts(20_000)
    want = [e.ids + [2] for e in encoder.model.encode_batch(some, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(some, 2)] == want


def test_pieces_give_the_counts_of_whole_texts(monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 5)
    some = [t + " and " + t[::-1] for t in texts(20_000)] + ["word " * 50_000, "x" * 50_000]
    model = token_counts.load(MODEL)
    assert model.safe
    assert token_counts.count_batch(some, MODEL).tolist() == model.count(some)
    assert token_counts.count_batch(["a b", None, ""], JSON).tolist() == [2, 0, 0]


def test_counts_in_spark(spark):
    df = spark.createDataFrame([(1, "a b c", 3), (1, "a b c", 3), (2, None, 0), (None, "", 0)], "doc_id long, text string, n_tokens int")
    got = sorted(((r.doc_id, r.n_tokens) for r in token_counts.with_token_count(df, MODEL).collect()), key=str)
    assert got == [(1, 3), (1, 3), (2, 0), (None, 0)]
    assert token_counts.with_token_count(df.limit(0), MODEL).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(9)
    for n in (0, 1, 2, 50, 5_000):
        keys = np.unique(rng.integers(0, 1 << 63, size=n, dtype=np.uint64))
        hashed = token_files.PerfectHash.build(keys)
        again = token_files.PerfectHash.load(hashed.dump())
        assert sorted(again.slots(keys).tolist()) == list(range(len(keys)))


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK_IDS", 50)
    monkeypatch.setattr(token_files, "BUCKET_KEYS", 40)
    rows = [(i * 3 % 301, t) for i, t in enumerate(texts(300))] + [(5, "same"), (5, "same"), (None, "no id"), (None, None), (900, None), (901, "long " * 9_000)]
    df = spark.createDataFrame([(d, t, 4) for d, t in rows], "doc_id long, text string, start int")
    got = token_files.round_trip(df, JSON, 2).collect()
    model = token_files.Encoder(JSON).model
    at, want = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = model.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_unknown_keys_are_not_found_and_empty_table(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    index, buckets = token_files.build_index(token_files.entries(token_files.write(df, JSON, 2)))
    keys = spark.range(150, 400).selectExpr("id AS doc_id", "0 AS occurrence")
    assert {r.doc_id for r in token_files.lookup(keys, index, buckets).collect()} == set(range(150, 200))
    assert token_files.round_trip(df.limit(0), JSON, 2).count() == 0


def test_keyed_read_opens_one_text(spark, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK_IDS", 60)
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(120)] + [(7, "seven again"), (None, "none"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    chunks = token_files.write(df, JSON, 2)
    index, buckets = token_files.build_index(token_files.entries(chunks))
    model = token_files.Encoder(JSON).model
    asked = spark.createDataFrame([(7, 0), (7, 1), (7, 2), (33, 0), (33, 0), (None, 0), (None, 1), (999, 0)], "doc_id long, occurrence int")
    for few in (1_000, 0):
        monkeypatch.setattr(token_files, "FEW_CHUNKS", few)
        got = [(r.doc_id, r.occurrence, np.frombuffer(bytes(r.payload), "<u2").tolist()) for r in token_files.fetch(asked, chunks, index, buckets).collect()]
        ids = lambda t: model.encode(t or "", add_special_tokens=False).ids + [2]
        want = [(7, 0, ids(rows[7][1])), (7, 1, ids("seven again")), (33, 0, ids(rows[33][1])), (33, 0, ids(rows[33][1])),
                (None, 0, ids("")), (None, 1, ids("none"))]
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_damage_is_an_error(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    chunks = token_files.write(df, JSON, 2)
    index, buckets = token_files.build_index(token_files.entries(chunks))
    keys = spark.range(60).selectExpr("id AS doc_id", "0 AS occurrence")
    with pytest.raises(Exception, match="not in the index"):
        token_files.lookup(keys, index, buckets, strict=True).collect()
    real = token_files.stored_sums
    try:
        token_files.stored_sums = lambda c: real(c).where("place <> 0")
        with pytest.raises(Exception, match="not those of the index"):
            token_files.round_trip(df, JSON, 2).collect()
    finally:
        token_files.stored_sums = real


def test_an_id_on_most_rows(spark):
    rows = [(None, f"t {i % 17}") for i in range(3000)] + [(4, "x")] * 900 + [(i, "y") for i in range(10, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    texts = token_files.entries(token_files.write(df, JSON, 2))
    keys = [(r.doc_id, r.occurrence) for r in texts.collect()]
    assert len(set(keys)) == len(rows) and max(k for d, k in keys if d is None) == 2999 and max(k for d, k in keys if d == 4) == 899
    starts = sorted((r.start, r.n_tokens) for r in texts.collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert token_files.round_trip(df, JSON, 2).count() == len(rows)


def test_units_are_cut_at_signs_and_odd_spaces_as_the_byte_level_rule_does(monkeypatch):
    """Slabs of a few bytes; signs, apostrophes, added tokens and spaces outside ASCII beside letters; equal hashes."""
    rng = random.Random(11)
    bits = ["word", "Word", "é", "don't", "'s", "''(re", "(", ").", "-", "<|endoftext|>", "</s>", "<s>", "a<s>b", " ", " ", "\n", "\n ", " ", "　", "\x1c", "7", "中", "́", "_", "'"]
    some = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(20_000)] + ["", "x" * 5_000, "(a)" * 3_000]
    want = [e.ids + [2] for e in token_files.Encoder(JSON).model.encode_batch(some, add_special_tokens=False)]
    for slab in (token_files.SLAB_BYTES, 300):
        monkeypatch.setattr(token_files, "SLAB_BYTES", slab)
        encoder = token_files.Encoder(JSON)
        assert [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(some, 2)] == want
    assert b" word" in encoder.known and b" word." not in encoder.known
    monkeypatch.setattr(token_files, "_PLAIN", token_files._PLAIN * np.uint64(0))
    assert [np.frombuffer(b, "<u2").tolist() for b in token_files.Encoder(JSON).encode(some[:500], 2)] == want[:500]
