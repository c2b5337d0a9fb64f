"""Sharding by minimax contiguous partition over ordered atomic groups.

Rows with equal texts are one atomic group; the groups stand in the order of a
64-bit hash of the text.  A contiguous partition into ``n_shards`` pieces is
sought whose largest piece is smallest: a binary search over the capacity with
a greedy check per capacity.

The groups may be far too many for one machine, so the search works on a
bounded summary: sums over intervals of the hash.  Every greedy check then has
a pessimistic answer (cuts only at interval ends) and an optimistic one (an
interval may be cut anywhere).  Where the two answers differ, the intervals
around the possible cuts are split by one more aggregation of the groups, until
both agree; the capacity is then exact.  All work on rows is DataFrame
operations; the driver holds at most about ``SUMMARY`` sums per round.

With the capacity fixed, the cuts are put where they leave the shards most
equal: a group larger than the mean shard would otherwise leave others empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import saved

SUMMARY_BITS = 16
SUMMARY = 1 << SUMMARY_BITS
ROW_OVERHEAD = 16          # bytes that a row takes besides its text
BUCKET_ROWS = 4_096        # rows of a hash bucket within a shard, on average


class Line:
    """Intervals of the ordered groups: ``(first key, shift, bytes, groups)``."""

    def __init__(self, items: list[tuple[int, int, int, int]]):
        self.items = sorted(items)
        self.ends = [0, *accumulate(i[2] for i in self.items)]
        self.total = self.ends[-1]

    def pessimistic(self, capacity: int, shards: int, at: int = 0) -> list[int]:
        """Greedy cut positions at interval ends; shorter than needed if stuck."""
        cuts = []
        while at < self.total and len(cuts) < shards:
            nxt = self.ends[bisect_right(self.ends, at + capacity) - 1]
            if nxt <= at:
                break
            cuts.append(at := nxt)
        return cuts

    def optimistic(self, capacity: int, shards: int) -> list[int]:
        """Positions that greedy cuts cannot go beyond."""
        cuts, at = [], 0
        while at < self.total and len(cuts) < shards:
            x = at + capacity
            if x < self.total:
                i = bisect_right(self.ends, x) - 1
                nxt = self.ends[i] if self.items[i][3] == 1 else x
            else:
                nxt = self.total
            if nxt <= at:
                break
            cuts.append(at := nxt)
        return cuts

    def least(self, check, shards: int) -> int:
        """Smallest capacity whose check reaches the end."""
        lo, hi = max(1, -(-self.total // shards)), max(1, self.total)
        while lo < hi:
            mid = (lo + hi) // 2
            cuts = check(mid, shards)
            if cuts and cuts[-1] >= self.total:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def undecided(self, low: int, high: int, shards: int) -> list[tuple[int, int]]:
        """Runs ``[i, j)`` of intervals in which a greedy cut for a capacity
        from ``low`` to ``high`` may fall and some interval can be split."""
        near, far = [0, *self.pessimistic(low, shards)], [0, *self.optimistic(high, shards)]
        near += [near[-1]] * (len(far) - len(near))
        runs: list[tuple[int, int]] = []
        for a, b in zip(near, far):
            first = max(0, bisect_right(self.ends, a + low) - 1)
            last = min(bisect_left(self.ends, b + high), len(self.items))
            if first < last:
                if runs and first <= runs[-1][1]:
                    runs[-1] = (runs[-1][0], max(last, runs[-1][1]))
                else:
                    runs.append((first, last))
        return [r for r in runs if any(i[3] > 1 for i in self.items[r[0]:r[1]])]

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Indices of the intervals that begin a shard: pieces near the mean of
        what is left, none above ``capacity``."""
        cuts, at = [], 0
        for left in range(shards, 1, -1):
            if at >= self.total:
                break
            want = at + (self.total - at) / left
            i = bisect_left(self.ends, want)
            most = bisect_right(self.ends, at + capacity) - 1
            least = bisect_right(self.ends, at)
            near = [j for j in sorted({i, i - 1, most}, key=lambda j: abs(self.ends[min(j, most)] - want)) if least <= j <= most]
            for j in near:
                rest = self.pessimistic(capacity, left - 1, self.ends[j])
                if self.ends[j] >= self.total or rest and rest[-1] >= self.total:
                    break
            cuts.append(j)
            at = self.ends[j]
        return [j for j in cuts if j < len(self.items)]


def _sums(groups: DataFrame, shift: int, bounds: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int, int]]:
    """Sums of the groups per hash interval of width ``2**shift``, within ``bounds``."""
    if bounds is not None:
        tests = [F.col("h").between(a, b) for a, b in bounds]
        while len(tests) > 1:                      # a balanced tree of ORs
            tests = [x | y for x, y in zip(tests[::2], tests[1::2])] + tests[len(tests) & ~1:]
        groups = groups.where(tests[0])
    rows = (groups.groupBy(F.shiftright("h", shift).alias("p"))
            .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).collect())
    return [(r.p << shift, shift, r.bytes, r.n) for r in rows]


def cut_keys(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """Hash keys at which shards 1, 2, ... begin, and the least capacity.
    ``groups`` has one row ``(h, bytes)`` per atomic group."""
    line = Line(_sums(groups, 64 - SUMMARY_BITS))
    while True:
        low, high = line.least(line.optimistic, shards), line.least(line.pessimistic, shards)
        if low == high:
            break
        runs = line.undecided(low, high, shards)
        inside = [line.items[i] for a, b in runs for i in range(a, b)]
        bits = max(1, SUMMARY_BITS - len(inside).bit_length())
        shift = max(0, min(i[1] for i in inside if i[3] > 1) - bits)
        bounds = [(line.items[a][0], line.items[b - 1][0] + (1 << line.items[b - 1][1]) - 1) for a, b in runs]
        gone = set(inside)
        line = Line([i for i in line.items if i not in gone] + _sums(groups, shift, bounds))
    return [line.items[j][0] for j in line.even_cuts(high, shards)], high


def _size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long")


def sharded(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with ``size`` (UTF-8 bytes and 16), ``text_crc32``, ``shard`` and
    ``slot`` (0, 1, 2, ... within a shard); columns of these names are replaced.

    Rows with equal texts share a shard; all null texts are one group (size 16,
    crc32 0).  Shards beyond the number of groups stay empty, an empty table
    gives an empty result.  Slots are numbered in two levels, so neither a
    shard nor a group of copies is gathered in one task; ties between equal
    rows are interchangeable.
    """
    rows = df.withColumn("_h", F.xxhash64(text_col))
    narrow = saved(rows.select(F.col(id_col).alias("i"), F.col("_h").alias("h"), _size(F.col(text_col)).alias("bytes")), "rows")
    groups = saved(narrow.groupBy("h").agg(F.sum("bytes").alias("bytes")), "groups")
    keys, _ = cut_keys(groups, n_shards)

    def shard_of(h: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(k) for k in keys]).cast("array<bigint>"), lambda k: k <= F.col(h)))

    buckets = max(1, -(-narrow.count() // (n_shards * BUCKET_ROWS)))

    def bucket_of(i: str, h: str) -> Column:
        return F.pmod(F.xxhash64(i, h), F.lit(buckets)).cast("int")

    over = Window.partitionBy("_shard").orderBy("_bucket")
    base = (narrow.groupBy(shard_of("h").alias("_shard"), bucket_of("i", "h").alias("_bucket")).agg(F.count("*").alias("_n"))
            .select("_shard", "_bucket", (F.sum("_n").over(over) - F.col("_n")).alias("_base")))
    inside = Window.partitionBy("_shard", "_bucket").orderBy("_h", id_col)
    return (rows.withColumn("size", _size(F.col(text_col)))
            .withColumn("text_crc32", F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)))
            .withColumn("_shard", shard_of("_h")).withColumn("_bucket", bucket_of(id_col, "_h"))
            .withColumn("_ord", F.row_number().over(inside))
            .join(base, ["_shard", "_bucket"])
            .withColumn("shard", F.col("_shard")).withColumn("slot", F.col("_base") + F.col("_ord") - 1)
            .drop("_h", "_shard", "_bucket", "_ord", "_base"))
