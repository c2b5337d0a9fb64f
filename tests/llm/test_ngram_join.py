import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from souk.llm import ngram_join
from souk.llm.common import release, saved, shingle_hashes, word_hashes

SCHEMA = "doc_id long, text string, size long, shard int"


def brute(rows, n, similarity):
    """Components by comparing every pair of word-shingle sets."""
    sets = []
    for _, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and rows[i][0] is not None and rows[j][0] is not None \
                    and 100 * len(a & sets[j]) >= similarity * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, len(s), low[find(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def run(spark, rows, n, similarity):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], SCHEMA)
    return sorted((tuple(r) for r in ngram_join.near_duplicates(df, n, similarity).collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.integers(len(words))] = f"edit{rng.integers(10 ** 6)}"
    return " ".join(words)


@pytest.mark.parametrize("n,similarity", [(3, 90), (5, 80)])
def test_equals_brute_force_with_nulls_ties_and_copies(spark, n, similarity):
    rng = np.random.default_rng(5)
    rows, at = [], 0
    for size in (1, 2, 4, 9, 20, 60, 200):
        base = [f"w{rng.integers(400)}" for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 3, 5):
            rows.append((at, edited(rng, base, edits)))
            at += 1
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "One two\nthree FOUR five six"), (904, "one two three four five SIX"),
             (905, "long " * 30_000), (905, "long " * 30_000), (None, "one two three four five six"), (None, None)]
    assert run(spark, rows, n, similarity) == brute(rows, n, similarity)


def test_linking_pairs_share_a_signature():
    """PartEnum's guarantee, over pairs right at the limit."""
    rng = np.random.default_rng(7)
    for similarity, (n2, k2) in ((90, (3, 1)), (80, (3, 1)), (80, (2, 1))):
        for size in (10, 11, 19, 40, 97, 300):
            for _ in range(40):
                a = rng.integers(0, 1 << 63, size=size, dtype=np.uint64)
                out = int(rng.integers(0, size))
                fresh = rng.integers(0, 1 << 63, size=size, dtype=np.uint64)
                b = np.concatenate([a[out:], fresh[:int(rng.integers(0, size))]])
                a, b = np.unique(a), np.unique(b)
                both = len(np.intersect1d(a, b))
                if 100 * both >= similarity * (len(a) + len(b) - both) and not np.array_equal(a, b):
                    sa, sb = (ngram_join.signatures(x, similarity, n2, k2) for x in (a, b))
                    assert len(np.intersect1d(sa, sb))


def test_slices_part_the_signatures_and_change_nothing(spark):
    rng = np.random.default_rng(9)
    for size in (3, 30, 400):
        s = np.unique(rng.integers(0, 1 << 63, size=size, dtype=np.uint64))
        parts = [ngram_join.signatures(s, 80, 3, 1, i, 2) for i in range(2)]
        assert sorted(np.concatenate(parts)) == sorted(ngram_join.signatures(s, 80, 3, 1))
    base = [f"w{i}" for i in range(150)]
    rows = [(d, edited(rng, base, int(rng.integers(0, 5)))) for d in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(df, 5, 80, slices=2).collect()), key=str)
    assert got == brute(rows, 5, 80)


def test_many_edited_copies_equal_brute_force(spark):
    """Variants of a few texts, many of which link only by way of others."""
    rng = np.random.default_rng(11)
    rows = []
    for _ in range(4):
        base = [f"w{rng.integers(4000)}" for _ in range(120)]
        rows += [(len(rows) + i, edited(rng, base, int(rng.integers(0, 6)))) for i in range(120)]
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)


def block(sketches, sizes=None, **more):
    n = len(sketches)
    cols = {"sig": 7, "bi": 0, "bj": 0, "side": 0, "key": range(n), "label": range(n), "size": sizes or [100] * n}
    return pd.DataFrame({k: [v] * n if isinstance(v, int) else list(v) for k, v in (cols | more).items()})


def sketch(*bits):
    words = np.zeros(ngram_join.SKETCH_WORDS, dtype=np.int64)
    for b in bits:
        words[b // 64] |= np.int64(np.uint64(1 << b % 64).astype(np.int64))
    return words


def test_a_block_gives_out_a_forest_and_not_all_pairs():
    n = 200
    part = block([sketch(i) for i in range(n)], sketch=[sketch(i) for i in range(n)], refuted=[None] * n)
    once = pd.concat(ngram_join._forests(90, 1)(iter([part])))
    assert len(once) == n - 1                            # and not n * (n - 1) / 2
    root = list(range(n))
    for a, b in zip(once["a"], once["b"]):               # the pairs join all groups
        old, new = root[a], root[b]
        root = [new if r == old else r for r in root]
    assert len(set(root)) == 1
    refuted = [np.array(sorted(once["a"][once["b"] == i]), dtype=np.int64) for i in range(n)]
    again = pd.concat(ngram_join._forests(90, 8)(iter([part.assign(refuted=refuted)])))
    pairs = set(zip(again["a"], again["b"]))
    assert len(pairs) == len(again) <= 8 * (n - 1) and not pairs & set(zip(once["a"], once["b"]))


def test_forests_of_a_later_round_hold_every_open_pair_once():
    n, calls = 60, []
    sketches = [sketch(*range(i, i + 12)) for i in range(n)]
    part = block(sketches, sketch=sketches, size=[60] * n, label=[i // 2 for i in range(n)],
                 refuted=[np.array([i - 3], dtype=np.int64) if i >= 3 else None for i in range(n)])
    got = pd.concat(ngram_join._forests(90, n)(iter([part])))
    pairs = list(zip(got["a"].tolist(), got["b"].tolist()))
    near = {(i, j) for i in range(n) for j in range(i + 1, n)
            if 190 * 2 * min(j - i, 12) <= 10 * 120 and i // 2 != j // 2 and j - i != 3}
    assert len(pairs) == len(set(pairs)) and set(pairs) == near
    counted = ngram_join.np.bitwise_count
    ngram_join.np.bitwise_count = lambda x: calls.append(1) or counted(x)
    try:
        list(ngram_join._forests(90, n)(iter([part])))
    finally:
        ngram_join.np.bitwise_count = counted
    assert len(calls) <= n                               # once a set, not once a set and forest


def test_blocks_of_few_entries_are_compared_together(monkeypatch):
    """As one by one, but not with calls for every block; the pieces of a block may lie in two batches."""
    rng, rows = np.random.default_rng(14), []
    for sig in range(150):
        keys, like = rng.choice(10_000, int(rng.integers(2, 12)), replace=False).tolist(), [sketch(*rng.integers(0, 500, 40).tolist()) for _ in range(2)]
        for k in keys:
            mine = like[k % 2] ^ sketch(*rng.integers(0, 500, int(rng.integers(0, 12))).tolist())
            rows.append((sig, 0, 0, 0, k, k % 5, int(rng.integers(85, 110)), mine, None if k % 3 else mine | like[0], mine,
                         None if k % 4 else np.array(keys[:2], dtype=np.int64)))
    part = pd.DataFrame(rows, columns=["sig", "bi", "bj", "side", "key", "label", "size", "every", "some", "sketch", "refuted"])
    counted, calls = np.bitwise_count, []

    def found(step):
        batches = [part.iloc[i:i + 300].reset_index(drop=True) for i in range(0, len(part), 300)]
        return set(map(tuple, pd.concat(step(iter(batches))).to_numpy().tolist()))

    monkeypatch.setattr(ngram_join.np, "bitwise_count", lambda x: calls.append(1) or counted(x))
    steps = ngram_join._undecided(80), ngram_join._forests(80, 64)
    together, few = [found(s) for s in steps], len(calls)
    monkeypatch.setattr(ngram_join, "FEW", 0)
    assert [found(s) for s in steps] == together and all(together)
    assert few < 100 < len(calls) - few


def test_sketches_that_differ_in_the_highest_bit_of_a_word_are_near():
    """numpy's count of a negative number's bits is that of its absolute value."""
    a, b = sketch(0, 1), sketch(0, 1, 63, 127, 191)
    part = block([a, b], every=[a, b], some=[None, None], sketch=[a, b], refuted=[None, None])
    assert len(pd.concat(ngram_join._undecided(90)(iter([part])))) == 2
    assert len(pd.concat(ngram_join._forests(90, 1)(iter([part])))) == 1


def test_empty_table(spark):
    assert run(spark, [], 3, 90) == []


def test_word_hashes_follow_the_word_rule():
    words, at = word_hashes(["A b\tc\x0bd e", None, "", "B", "é É"])
    assert list(np.diff(at)) == [4, 0, 0, 1, 2]
    assert words[1] == words[4] and words[5] != words[6]        # A-Z only is folded
    long = word_hashes(["x" * 3_000_000 + " y"])[0]
    assert len(long) == 2 and long[1] == word_hashes(["y"])[0][0]
    assert len(shingle_hashes(words[:2], 3)) == 1


def test_one_signature_of_each_list_of_sets(spark):
    """Signatures with the same sets say the same; repeats do not matter."""
    rows = [(s, 1, k) for s in (10, 11, 12) for k in (1, 2, 3)] + [(13, 1, 1), (13, 1, 2), (13, 1, 2), (14, 4, 4), (14, 4, 5), (10, 1, 3)]
    got = ngram_join._of_each_list(spark.createDataFrame(rows, "sig long, low long, set_key long")).collect()
    assert sorted(map(tuple, got)) == [(10, 1, 1), (10, 1, 2), (10, 1, 3), (13, 1, 1), (13, 1, 2), (14, 4, 4), (14, 4, 5)]


def test_filter_of_shared_signatures_has_the_size_of_their_number(spark):
    few = spark.range(1_000).selectExpr("xxhash64(id) AS sig")
    assert len(ngram_join._bitmap(few)) == 1 << 14          # 2^17 bits
    assert len(ngram_join._bitmap(few.limit(0))) == 1 << ngram_join.BITMAP_LEAST - 3


def test_shuffle_files_of_the_last_step_are_released(spark):
    def files():
        env = spark._jvm.org.apache.spark.SparkEnv.get()
        return {f for f in env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}

    def step():
        rows = spark.range(20_000).selectExpr("xxhash64(id) AS sig", "id AS set_key")
        return saved(rows.groupBy("sig").agg(F.min("set_key").alias("low")), "released")

    before = files()
    table = step()
    assert files() - before
    release(spark)
    end = time.time() + 10
    while files() - before and time.time() < end:
        time.sleep(0.1)
    assert not files() - before and table.count() == 20_000


def test_entries_in_blocks_meet_their_facts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    entries = [(1, k, k % 3) for k in range(10)] + [(2, 3, 0), (2, 4, 1)]
    facts = [(k, 100 + k) for k in range(12)]
    got = ngram_join._in_blocks(spark.createDataFrame(entries, "sig long, key long, label long"),
                                spark.createDataFrame(facts, "key long, size long")).collect()
    assert all(r["size"] == 100 + r["key"] and r["label"] == dict((e[:2], e[2]) for e in entries)[r["sig"], r["key"]] for r in got)
    together = {(r["sig"], *sorted((r["key"], s["key"]))) for r in got for s in got if (r["sig"], r["bi"], r["bj"]) == (s["sig"], s["bi"], s["bj"])}
    assert {(1, a, b) for a in range(10) for b in range(a + 1, 10)} <= together and (2, 3, 4) in together
