"""Spelling variants: words one edit apart, found by pivotal grams.

For words of a vocabulary that differ by exactly one inserted, deleted or
replaced code point.  All bigrams have a global order, rarest first.  A word's
prefix is its three rarest bigrams (with every tie of the third); its pivots
are the two disjoint bigrams of the three with the least summed frequency,
chosen by dynamic programming.  One edit spoils at most one of two disjoint
bigrams, so of two near words the one whose third bigram comes first in the
order keeps a pivot that lies in the other's prefix.

The position limits of the index are exact: one edit left of a surviving
bigram leaves everything from the bigram on as it was, one right of it
everything up to it.  Of the part with the edit, the half away from it (its
``h`` first or ``h`` last code points) is also unchanged.  A signature is
therefore a bigram with one whole side of the word, one half of the other side
and the other word's length; words of a signature share about three quarters
of their letters, so groups stay small in any vocabulary.  A signature stands
for its parts by a 64-bit hash; pairs are verified on the words themselves.

Nulls and other cases: null words are left out; a repeated word counts as one
(its counts are summed by ``variant_forms``); words shorter than 4 code points
have too few bigrams and raise; an empty vocabulary gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import drop_saved, mix64, saved

RUN = "[a-zÀ-ÿ]"      # after A-Z are lower-cased
MIN_LENGTH = 7
MIN_COUNT = 2
SLIP = 31                       # one run in 31 loses a code point
FACTOR = 10                     # a form is this often as frequent as its variant
FLUSH = 200_000                 # distinct words a task counts before it gives them out
LEAST = 4                       # code points: three bigrams

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


# --- the vocabulary ---------------------------------------------------------

def _count_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    find = re.compile(f"{RUN}{{{MIN_LENGTH},}}").findall       # shorter runs cannot give a word
    counts: Counter = Counter()

    def out() -> pd.DataFrame:
        return pd.DataFrame({"word": list(counts), "n": np.fromiter(counts.values(), dtype=np.int64, count=len(counts))})

    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            if not text:
                continue
            start = zlib.crc32(f"{doc_id or ''}:".encode())
            runs = Counter(find(text.encode("utf-8").lower().decode("utf-8")))     # bytes: only A-Z change
            for run, n in runs.items():
                h = zlib.crc32(run.encode("utf-8"), start)
                if h % SLIP == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < MIN_LENGTH:
                        continue
                counts[run] += n
            if len(counts) >= FLUSH:
                yield out()
                counts.clear()
    if counts:
        yield out()


def run_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: the lower-cased letter runs of all texts, as often as they
    occur; where crc32 of ``<doc_id>:<run>`` is a multiple of 31 the run has lost
    the code point at the checksum modulo its length.  Words of at least 7 code
    points and 2 occurrences.  A null ``doc_id`` is the empty string."""
    plain = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (plain.mapInPandas(_count_runs, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT))


# --- signatures -------------------------------------------------------------

def _by_length(words: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length: their places and their code points as a matrix."""
    sizes = words.str.len().to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        step = max(1, 4_000_000 // int(size))
        for part in (rows[i:i + step] for i in range(0, len(rows), step)):
            text = "".join(words.iloc[part]).encode("utf-32-le")
            yield part, np.frombuffer(text, dtype=np.uint32).reshape(len(part), size).astype(np.int64)


def _grams(points: np.ndarray) -> np.ndarray:
    return (points[:, :-1] << 21) | points[:, 1:]


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for _, points in _by_length(pdf["word"]):
            gram, n = np.unique(_grams(points), return_counts=True)
            yield pd.DataFrame({"gram": gram, "n": n.astype(np.int64)})


def choose_pivots(places: np.ndarray, cost: np.ndarray, picks: int = 2) -> np.ndarray:
    """Per row, ``picks`` pairwise disjoint bigrams of least summed cost.

    ``places`` (ascending) and ``cost`` are rows x candidates.  Dynamic
    programme over the candidates from left to right: the best choice of j
    among the first i either leaves the i-th out or takes it after the best
    choice of j - 1 among those that end before it begins.
    """
    rows, width = places.shape
    never = np.iinfo(np.int64).max // 4
    best = np.full((rows, width + 1, picks + 1), never, dtype=np.int64)
    best[:, :, 0] = 0
    took = np.zeros((rows, width + 1, picks + 1), dtype=bool)
    before = np.stack([(places + 2 <= places[:, [i]]).sum(axis=1) for i in range(width)], axis=1)
    each = np.arange(rows)
    for i in range(1, width + 1):
        for j in range(1, picks + 1):
            leave, take = best[:, i - 1, j], best[each, before[:, i - 1], j - 1] + cost[:, i - 1]
            took[:, i, j] = take < leave
            best[:, i, j] = np.minimum(leave, take)
    chosen = np.zeros((rows, picks), dtype=np.int64)
    i = np.full(rows, width)
    for j in range(picks, 0, -1):
        while True:
            skip = ~took[each, i, j]
            if not skip.any():
                break
            i = i - skip
        chosen[:, j - 1] = places[each, i - 1]
        i = before[each, i - 1]
    return chosen


class _Hashes:
    """Hashes of all substrings of the rows of a matrix, by prefix sums."""

    def __init__(self, points: np.ndarray):
        rows, self.size = points.shape
        self.up = np.concatenate(([_U(1)], np.cumprod(np.full(self.size, _BASE, dtype=_U), dtype=_U)))
        self.sums = np.zeros((rows, self.size + 1), dtype=_U)
        np.cumsum(mix64(points.astype(_U) + _U(1)) * self.up[:-1], axis=1, dtype=_U, out=self.sums[:, 1:])

    def of(self, row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Position-free hash of ``points[row, lo:hi]``."""
        raised = (self.sums[row, hi] - self.sums[row, lo]) * self.up[self.size - lo]
        return mix64(raised * self._unshift() + (hi - lo).astype(_U))

    def _unshift(self) -> np.uint64:
        # bring every length to one power, so words of different lengths agree
        return _U(pow(int(_BASE), -self.size, 1 << 64))


def _signatures(hashes: _Hashes, row: np.ndarray, at: np.ndarray, right: bool, half: np.ndarray) -> Iterator[np.ndarray]:
    """Two signatures per entry.  ``right``: the side from the bigram on is
    whole and ``at`` is where it begins; else the side up to ``at`` is."""
    size = np.full(len(row), hashes.size)
    zero = np.zeros(len(row), dtype=np.int64)
    tag = half.astype(_U) * _U(4) + _U(2 * right)
    if right:
        yield mix64(hashes.of(row, at - half, size) + mix64(tag))
        yield mix64(hashes.of(row, zero, half) * _U(3) + hashes.of(row, at, size) + mix64(tag + _U(1)))
    else:
        yield mix64(hashes.of(row, zero, at + half) + mix64(tag))
        yield mix64(hashes.of(row, size - half, size) * _U(3) + hashes.of(row, zero, at) + mix64(tag + _U(1)))


def _keyed(sig: np.ndarray, size: int) -> np.ndarray:
    return mix64(sig + mix64(np.full(len(sig), size, dtype=_U))).astype(np.int64)


def _index(order: tuple[np.ndarray, np.ndarray], pivots: bool):
    """Arrow function giving the signatures of every word: of its pivots
    (asking for words of its length and one more or less), or of its prefix."""
    gram_ids, gram_n = order

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            words, counts = pdf["word"], pdf["n"].to_numpy()
            for part, points in _by_length(words):
                rows, size = points.shape
                if size < LEAST:
                    raise ValueError(f"words need at least {LEAST} code points")
                rank = np.searchsorted(gram_ids, _grams(points))
                n = gram_n[rank]
                # global order: frequency, then the bigram; places of equal bigrams ascend
                by = np.lexsort((rank, n), axis=1)
                first = by[:, :3]
                last_n, last_rank = np.take_along_axis(n, first[:, 2:], 1), np.take_along_axis(rank, first[:, 2:], 1)
                hashes = _Hashes(points)
                keys, of = [], []
                if pivots:
                    places = np.sort(first, axis=1)
                    two = choose_pivots(places, np.take_along_axis(n, places, 1))
                    row = np.arange(rows)
                    # edit left of the first pivot, in it or left of the second, right of the first
                    for at, right in ((two[:, 0], True), (two[:, 1], True), (two[:, 0] + 2, False)):
                        half = (at if right else size - at) // 2
                        for sig in _signatures(hashes, row, at, right, half):
                            for other in (size - 1, size, size + 1):
                                keys.append(_keyed(sig, other))
                                of.append(row)
                else:
                    row, at0 = np.nonzero((n < last_n) | ((n == last_n) & (rank <= last_rank)))
                    for at, right in ((at0, True), (at0 + 2, False)):
                        side = at if right else size - at
                        for less in (0, 1):              # halves of sides one shorter, equal, one longer
                            half = (side + 1) // 2 - less
                            fits = (half >= 0) & (half <= side)
                            for sig in _signatures(hashes, row[fits], at[fits], right, half[fits]):
                                keys.append(_keyed(sig, size))
                                of.append(row[fits])
                where = part[np.concatenate(of)]
                # the place in the order of the third bigram, as one number
                third = (last_n[:, 0] * (len(gram_ids) + 1) + last_rank[:, 0])[np.concatenate(of)]
                yield pd.DataFrame({"key": np.concatenate(keys), "word": words.to_numpy()[where], "n": counts[where],
                                    "third": third.astype(np.int64)})
    return run


def near_words(vocab: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b``: every unordered pair of words (``word, n``, distinct
    words) that differ by exactly one code point, once; a stored table."""
    spark = vocab.sparkSession
    vocab = vocab.where("word is not null")
    grams = vocab.select("word").mapInPandas(_count_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    # 26 + 64 letters: at most 8,100 bigrams reach the driver
    table = sorted((r.gram, r.n) for r in grams.collect())
    order = np.array([g for g, _ in table], dtype=np.int64), np.array([n for _, n in table], dtype=np.int64)
    schema = "key long, word string, n long, third long"
    asks = vocab.mapInPandas(_index(order, True), schema).toDF("key", "a", "n_a", "third_a")
    holds = vocab.mapInPandas(_index(order, False), schema).toDF("key", "b", "n_b", "third_b")
    same = (F.col("third_a") <= F.col("third_b")) & (F.col("a") != F.col("b")) & (F.levenshtein("a", "b", 1) == 1)
    found = asks.join(holds.hint("shuffle_merge"), "key").where(same)
    first = F.col("a") < F.col("b")
    pair = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                        F.when(first, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
                        F.when(first, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"))
    return saved(pair.distinct(), "near-words")


def variant_forms(vocab: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``vocab``
    (``word, n``).  A word's form is its near word of largest ``n`` (ties: the
    smallest in code-point order), if at least 10 times as frequent, else null;
    its root is where the forms end."""
    spark = vocab.sparkSession
    vocab = saved(vocab.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    pairs = near_words(vocab)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("top"))
    rows = vocab.join(best, "word", "left")
    is_form = -F.col("top.m") >= FACTOR * F.col("n")
    rows = saved(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(is_form, F.col("top.other")).alias("form"),
                             F.when(is_form, -F.col("top.m")).cast("long").alias("form_n")), "forms")
    # follow the forms by doubling: counts grow tenfold a step, so a chain has at most 18 steps
    step = saved(rows.where("form is not null").select("word", F.col("form").alias("to")), "roots")
    made = [step]
    while step.join(step.select(F.col("word").alias("to")), "to", "left_semi").limit(1).count():
        further = step.select(F.col("word").alias("to"), F.col("to").alias("next"))
        step = saved(step.join(further, "to", "left").select("word", F.coalesce("next", "to").alias("to")), "roots")
        made.append(step)
    out = rows.join(step.withColumnRenamed("to", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    drop_saved(spark, vocab, pairs, *made[:-1])
    return out
