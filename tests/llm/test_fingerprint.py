import hashlib

import pytest
from pyspark.sql import functions as F

from souk.llm import fingerprint


def vectors(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return {r.i: list(r.v) for r in fingerprint.with_vector(df, "text", "v").collect()}


def test_order_independent_and_incremental(spark):
    a, b = "First line. Two sentences\n\nthird", "other\nlines here"
    v = vectors(spark, [a + "\n" + b, b + "\n" + a, a, b, a + "\n" + b + "\nother", None, ""])
    assert v[0] == v[1] != v[4] and v[5] == v[6] and sum(v[5]) == 0
    df = spark.createDataFrame([(v[0], v[2], v[3])], "w array<long>, a array<long>, b array<long>")
    row = df.select(fingerprint.insert(F.col("a"), F.col("b")).alias("plus"), fingerprint.delete(F.col("w"), F.col("b")).alias("minus")).first()
    assert row.plus == v[0] and row.minus == v[2]


@pytest.mark.parametrize("group_rows", [4_096, 3])
def test_edited_texts(spark, monkeypatch, group_rows):
    monkeypatch.setattr(fingerprint, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(fingerprint, "CELLS", 3)
    rows = [(i * 7 % 83 * 1000, f"Text number {i} é中. And more of it.\nA line {i * i}") for i in range(83)]
    rows += [(-5, None), (10 ** 12, ""), (10 ** 12 + 1, "last " * 20_000), (10 ** 12 + 2, "x")]
    df = spark.createDataFrame([(d, t, "n") for d, t in rows], "doc_id long, text string, hash string")
    got = {r.doc_id: r for r in fingerprint.edited_fingerprints(df).collect()}
    assert len(got) == len(rows)
    ordered = sorted(rows)
    for i, (d, t) in enumerate(ordered):
        t, after = t or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        want = t[:len(t) - half] + after[:half]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
        assert (got[d].fingerprint == got[d].edited_fingerprint) == (want == t)


def test_repeated_rows_and_likeness(spark):
    text = "\n".join(f"line {i} of the text" for i in range(60))
    other = "\n".join(f"quite another {i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text), (2, other), (None, other)], "doc_id long, text string")
    got = fingerprint.edited_fingerprints(df).collect()
    assert len(got) == 4 and len({r.fingerprint for r in got}) == 2
    same = [r for r in got if r.doc_id == 1]
    assert {r.near_next == 1.0 for r in same} == {True, False}          # the copy, then the other text
    assert min(r.near_next for r in same) < 0.3 < max(r.near_edited for r in got if r.doc_id == 2)
    assert fingerprint.edited_fingerprints(df.limit(0)).count() == 0
