import zlib

import numpy as np

from souk.llm import sharding


def least_capacity(sizes, k):
    """Smallest largest piece, by trying every capacity upwards."""
    for c in range(max(max(sizes), -(-sum(sizes) // k)), sum(sizes) + 1):
        pieces, run = 1, 0
        for s in sizes:
            if run + s > c:
                pieces, run = pieces + 1, 0
            run += s
        if pieces <= k:
            return c


def test_capacity_is_minimal_with_a_coarse_summary(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SUMMARY_BITS", 4)            # 16 intervals: several rounds are needed
    rng = np.random.default_rng(4)
    for heavy, shards in ((0, 7), (40_000, 5), (900, 12)):
        h = sorted(rng.integers(-2 ** 63, 2 ** 63 - 1, 400).tolist())
        sizes = rng.integers(1, 100, 400).tolist()
        sizes[200] += heavy
        keys, capacity = sharding.cut_keys(spark.createDataFrame(list(zip(h, sizes)), "h long, bytes long"), shards)
        assert capacity == least_capacity(sizes, shards)
        pieces = np.zeros(shards, dtype=int)
        for x, s in zip(h, sizes):
            pieces[sum(k <= x for k in keys)] += s
        assert pieces.max() == capacity and pieces.min() > 0


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "a", 7) for d, t in rows], "doc_id long, text string, slot string, size int")


def test_copies_share_a_shard_and_slots_have_no_gap(spark):
    rows = [(i, f"text {i}" * (i % 30)) for i in range(500)] + [(1000 + i, "copy") for i in range(300)]
    rows += [(None, None), (2000, None), (2001, ""), (2002, "é" * 20_000), (7, "text 7" * 7)]
    out = sharding.sharded(docs(spark, rows), 12).collect()
    assert len(out) == len(rows) and out[0].__fields__ == ["doc_id", "text", "slot", "size", "text_crc32", "shard"]
    place, slots = {}, {}
    for r in out:
        raw = (r.text or "").encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
        assert place.setdefault(r.text, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(12)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    again = sharding.sharded(docs(spark, rows[::-1]).repartition(4), 12).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_empty_table_and_fewer_groups_than_shards(spark):
    assert sharding.sharded(docs(spark, []), 40).count() == 0
    assert {r.shard for r in sharding.sharded(docs(spark, [(1, "a"), (2, "b")]), 40).collect()} <= set(range(40))
