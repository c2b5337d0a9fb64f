import numpy as np

from souk.llm import mixing


def water(sizes, weights, most):
    """Round by round: share, stop the ones above, share the rest again."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while open_:
        mass = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / mass > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / mass
            break
        for i in over:
            out[i] = most * sizes[i]
            open_.discard(i)
        left = sum(sizes) - sum(out[i] for i in range(len(sizes)) if i not in open_)
    return out


def test_targets_equal_rounds_of_sharing():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 9))
        sizes = [int(x) for x in rng.integers(0, 1000, n) * (rng.random(n) < 0.8)]
        weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(n)]
        assert np.allclose(mixing.targets(sizes, weights), water(sizes, weights, 3))


def test_tree_leaves_add_up_and_blocks_are_drawn_once():
    quotas = np.array([17, 0, 401, 5], dtype=np.int64)
    seen = {k: [] for k in range(4)}
    for j in range(9):
        count, begin = mixing.leaf(quotas, 9, j, 3)
        assert count.sum() in (423 // 9, 423 // 9 + 1)
        for k in np.flatnonzero(count):
            seen[k] += mixing.permuted(np.arange(begin[k], begin[k] + count[k]), int(quotas[k]), 11).tolist()
    assert all(sorted(seen[k]) == list(range(quotas[k])) for k in range(4))


def docs(spark, rows):
    return spark.createDataFrame([(d, s, t, 5, 6) for d, s, t in rows], "doc_id long, source string, text string, size long, shard int")


def test_taken_words_meet_targets_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 4)
    rng = np.random.default_rng(2)
    rows = [(i, None if i % 11 == 0 else f"s{i % 4}" if i % 3 else "big", " ".join(["w"] * int(rng.integers(0, 60)))) for i in range(700)]
    rows += [(5, "s1", "a b c"), (5, "s1", "a b c"), (None, "s2", "x y"), (9, "s3", None), (10, "solo", "\t\n "), (11, "s0", "w " * 30_000)]
    out = mixing.taken(docs(spark, rows), block_words=64).collect()
    again = mixing.taken(docs(spark, rows[::-1]).repartition(5), block_words=64).collect()
    assert sorted(map(str, out)) == sorted(map(str, again)) and len(out) == len(rows)
    by = {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault((r.source_size, r.target), []).append(r)
    for (size, target), rs in by.items():
        assert sum(r.size for r in rs) == size and abs(sum(r.taken for r in rs) - target) <= 0.5


def test_draws_fill_shards_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 3)
    rows = [(i, f"s{i % 5}", "a b c d " * (i % 9)) for i in range(400)]
    placed, cat = mixing.placed(docs(spark, rows), block_words=40)
    got = mixing.draws(placed, cat).collect()
    assert sum(r.words for r in got) == sum(k for *_, k, _ in cat.rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(slots) > 3 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    for shard in slots:                                        # a shard holds the blocks that its leaf of the tree drew
        count, begin = mixing.leaf(cat.quotas, cat.shards, shard, 17)
        drawn = {(k, int(b)) for k in np.flatnonzero(count)
                 for b in mixing.permuted(np.arange(begin[k], begin[k] + count[k]), int(cat.quotas[k]), 17 * 1_000_003 + int(k))}
        mine = {(r.source_no, r.block) for r in got if r.shard == shard}
        assert mine <= drawn                                   # a block in which no copy begins has no row
    first = {(r.doc_id, r.source): (r.shard, r.slot) for r in sorted(got, key=lambda r: -r.copy)}
    out = mixing.taken(docs(spark, rows), block_words=40).collect()
    assert {(r.doc_id,): (r.shard, r.slot) for r in out if r.copies} == {k[:1]: v for k, v in first.items()}
    assert all(r.shard is None for r in out if not r.copies)


def test_mixed_keeps_columns_and_empty_table(spark):
    rows = [(i, f"s{i % 2}", "a b c") for i in range(40)]
    out = mixing.mixed(docs(spark, rows))
    assert out.columns == ["doc_id", "source", "text", "size", "shard"] and out.count() == 40
    assert mixing.taken(docs(spark, [])).count() == 0 and mixing.mixed(docs(spark, [])).count() == 0
