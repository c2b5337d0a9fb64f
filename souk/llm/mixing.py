"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Every source's share of the words follows its weight; a share stops at
   ``max_repeat`` times the source's words and the excess goes to the others.
2. A source's documents stand in a seeded random order; the mix takes the
   first *target* words of that order repeated ``max_repeat`` times.  Places in
   the order are prefix sums in two levels (within hash buckets, over buckets),
   so a source of any size is spread over many tasks.
3. The taken words are cut into blocks; the exact block quotas of all sources
   are split over the output shards by a binary tree: each node draws, with a
   generator seeded by the node, how many blocks of every source go left
   (multivariate hypergeometric).  Every shard walks its own path from the
   root, so the leaves are made independently and still add up to the quotas.
4. A shard draws a range of its source's permuted blocks (a keyed bijection,
   so ranges of different shards are disjoint) and shuffles its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import WORD, mix64, saved

BLOCK_WORDS = 16_384          # words of a block
SHARD_BLOCKS = 128            # blocks of an output shard
MOST_BLOCKS = 500_000_000     # the generator's limit is 10**9; blocks grow instead
MAX_SOURCES = 100_000         # rows of the source catalogue; more is an error, nothing is dropped
BUCKET_DOCS = 4_096           # documents of a hash bucket, on average
ROW = ["source_no", "bucket", "ord"]

_U = np.uint64


def word_count(text) -> "F.Column":
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], max_repeat: int = 3) -> list[float]:
    """Shares of ``sum(sizes)`` by weight, none above ``max_repeat`` times its
    source's size; what exceeds is shared again by weight."""
    left, out = float(sum(sizes)), [0.0] * len(sizes)
    caps = [float(max_repeat * s) for s in sizes]
    order = sorted(range(len(sizes)), key=lambda i: caps[i] / weights[i])
    mass = float(sum(weights))
    for i in order:            # the source that fills up first comes first
        out[i] = min(caps[i], left * weights[i] / mass)
        left -= out[i]
        mass -= weights[i]
        if mass <= 0:
            break
    return out


@dataclass
class Catalogue:
    """Per source: its number, words, target and hash buckets."""

    rows: list[tuple]           # (source_no, source, source_size, target, take, buckets)
    block_words: int
    quotas: np.ndarray          # blocks per source

    @property
    def shards(self) -> int:
        return max(1, -(-int(self.quotas.sum()) // SHARD_BLOCKS))


def catalogue(sized: DataFrame, weights: tuple[float, ...], max_repeat: int, block_words: int) -> Catalogue:
    found = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("docs")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r.source is None, r.source or ""))      # code point order, null last
    want = targets([r.n for r in found], [float(weights[i % len(weights)]) for i in range(len(found))], max_repeat)
    take = [min(max_repeat * r.n, round(t)) for r, t in zip(found, want)]
    block = max(block_words, -(-sum(take) // MOST_BLOCKS))
    rows = [(i, r.source, r.n, float(t), int(k), max(1, -(-r.docs // BUCKET_DOCS)))
            for i, (r, t, k) in enumerate(zip(found, want, take))]
    return Catalogue(rows, block, np.array([-(-k // block) for k in take], dtype=np.int64))


def placed(df: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeat: int = 3, seed: int = 17,
           block_words: int = BLOCK_WORDS) -> tuple[DataFrame, Catalogue]:
    """Every row of ``df`` (``doc_id, source, text``) with its place in its
    source's random order (``start``, in words)."""
    spark = df.sparkSession
    sized = saved(df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                            word_count(F.col("text")).alias("size")), "sizes")
    cat = catalogue(sized, weights, max_repeat, block_words)
    table = spark.createDataFrame(cat.rows, "source_no int, cat_source string, source_size long, target double, take long, buckets int")
    table = F.broadcast(table)                    # at most MAX_SOURCES rows, checked above
    rows = (sized.join(table, sized["source"].eqNullSafe(table["cat_source"])).drop("cat_source")
            .withColumn("h", F.xxhash64(F.lit(seed), "source_no", "doc_id", "size"))
            .withColumn("bucket", F.pmod("h", F.col("buckets").cast("long")).cast("int")))
    inside = Window.partitionBy("source_no", "bucket").orderBy("h", "doc_id", "size")
    over = Window.partitionBy("source_no").orderBy("bucket")
    base = (rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("n"))
            .withColumn("base", F.sum("n").over(over) - F.col("n")).drop("n"))
    rows = (rows.withColumn("ord", F.row_number().over(inside))
            .withColumn("within", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
            .join(base, ["source_no", "bucket"])
            .select("doc_id", "source", "size", "source_size", "target", "take", *ROW,
                    (F.col("base") + F.col("within")).alias("start")))
    return saved(rows, "places"), cat


def leaf(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of every source in ``shard``, and where they begin in the
    sources' permuted orders."""
    total = int(quotas.sum())
    lo, hi = 0, shards
    mine, begin = quotas.copy(), np.zeros_like(quotas)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(mine, total * mid // shards - total * lo // shards, method="marginals")
        if shard < mid:
            mine, hi = left, mid
        else:
            mine, begin, lo = mine - left, begin + left, mid
    return mine, begin


def permuted(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed bijection of ``range(n)``: a four-round Feistel network on the
    next even power of two, walked until it falls inside."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    low = _U((1 << half) - 1)
    x, out = i.astype(_U), np.zeros(len(i), dtype=np.int64)
    todo = np.arange(len(i))
    while len(todo):
        a, b = x >> _U(half), x & low
        for r in range(4):
            a, b = b, a ^ (mix64(b + _U((key * 4 + r + 1) * 0x9E3779B97F4A7C15 & ((1 << 64) - 1))) & low)
        x = (a << _U(half)) | b
        inside = x < _U(n)
        out[todo[inside]] = x[inside].astype(np.int64)
        todo, x = todo[~inside], x[~inside]
    return out


def _leaves(quotas: np.ndarray, shards: int, seed: int):
    def run(batches):
        for pdf in batches:
            for shard in pdf["id"]:
                count, begin = leaf(quotas, shards, int(shard), seed)
                parts = [(k, permuted(np.arange(begin[k], begin[k] + count[k]), int(quotas[k]), seed * 1_000_003 + int(k)))
                         for k in np.flatnonzero(count)]
                if parts:
                    yield pd.DataFrame({
                        "source_no": np.repeat(np.array([k for k, _ in parts], dtype=np.int32), [len(b) for _, b in parts]),
                        "block": np.concatenate([b for _, b in parts]), "shard": np.int64(shard)})
    return run


def draws(rows: DataFrame, cat: Catalogue, max_repeat: int = 3, seed: int = 17) -> DataFrame:
    """One row per drawn copy: ``doc_id, source, size, copy, words, block,
    shard, slot`` and the row key.  ``words`` is less than ``size`` for the one
    copy per source at which the target is reached."""
    spark = rows.sparkSession
    begin = F.col("copy") * F.col("source_size") + F.col("start")
    copies = (rows.where("size > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
              .withColumn("begin", begin).withColumn("words", F.least(F.col("size"), F.col("take") - F.col("begin")))
              .where("words > 0").withColumn("block", F.expr(f"begin div {cat.block_words}")))
    tasks = max(1, min(cat.shards, spark.sparkContext.defaultParallelism * 4))
    blocks = spark.range(0, cat.shards, 1, tasks).mapInPandas(
        _leaves(cat.quotas, cat.shards, seed), "source_no int, block long, shard long")
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "source_no", "begin"), "source_no", "begin")
    return (copies.join(blocks, ["source_no", "block"])
            .withColumn("slot", F.row_number().over(local).cast("long") - 1)
            .select("doc_id", "source", "size", "copy", "words", *ROW, "block", "shard", "slot"))


def taken(df: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeat: int = 3, seed: int = 17,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per input row: ``doc_id, size, source_size, target, taken, copies, shard,
    slot``: the words and copies that the mix takes, and where the tree and the
    local shuffle put the first copy (null if none).

    Needs ``doc_id, source, text``; other columns are ignored.  A null text has
    size 0; a null source is a source of its own, last in order; rows without
    an id are drawn like others; repeated rows are rows of their own.  Sources
    without words have target 0.  An empty table gives an empty result.
    """
    rows, cat = placed(df, weights, max_repeat, seed, block_words)
    got = (draws(rows, cat, max_repeat, seed).groupBy(*ROW)
           .agg(F.sum("words").alias("got"), F.count("*").alias("copies"), F.min(F.struct("copy", "shard", "slot")).alias("first")))
    return (rows.join(got, ROW, "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("got", F.lit(0)).cast("long").alias("taken"),
                    F.coalesce("copies", F.lit(0)).cast("long").alias("copies"),
                    F.col("first.shard").alias("shard"), F.col("first.slot").alias("slot")))


def mixed(df: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeat: int = 3, seed: int = 17) -> DataFrame:
    """The rows of ``df`` as often as the mix draws them, whole: a source's
    last, partly drawn copy is in if at least half of its words are.  Texts
    without words are not drawn.  Rows alike in id, source, size and text are
    drawn alike (their mean, rounded)."""
    keyed = df.withColumn("_mix_key", F.xxhash64("doc_id", "source", "text"))
    rows, cat = placed(keyed.select(F.col("_mix_key").alias("doc_id"), "source", "text"), weights, max_repeat, seed)
    got = (draws(rows, cat, max_repeat, seed).where("2 * words >= size").groupBy(*ROW).agg(F.count("*").alias("c")))
    times = (rows.join(got, ROW, "left").groupBy("doc_id").agg(F.round(F.avg(F.coalesce("c", F.lit(0)))).cast("int").alias("_mix_times"))
             .where("_mix_times > 0").withColumnRenamed("doc_id", "_mix_key"))
    return (keyed.join(times, "_mix_key")
            .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_times")))).select(df.columns))
