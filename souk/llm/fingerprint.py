"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph (a line) and each of its sentences is hashed to a wide vector of
126 bits; the fingerprint is the lane-wise sum of the vectors of all elements,
with their number, modulo powers of two.  Three 21-bit lanes share a long, so a
sum of longs modulo 2**62 is a sum of lanes.

* Order-independent: texts with the same paragraphs in any order are equal.
* Incremental: :func:`insert` and :func:`delete` add or take away a text's
  paragraphs without the rest of the document.
* Graded: a lane counts how many of ``n`` elements have the bit set, so
  ``2 * count - n`` are random-sign sums, and the scalar product of two
  fingerprints estimates the number of elements they share.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import saved

LANES_PER_LONG = 3
LANE_BITS = 21
LONGS = 21                                      # per hash; two hashes
MODULUS = (1 << 62) - 1
_SPREAD = 1 | 1 << LANE_BITS | 1 << 2 * LANE_BITS
_LANE = (1 << LANE_BITS) - 1
GROUP_ROWS = 4_096                              # rows of a sort group, on average
CELLS = 1_000                                   # most id quantiles
BROADCAST_GROUPS = 200_000                      # group rows that may be broadcast; checked by a count


def _elements(text: Column, first: int) -> Column:
    """64-bit hashes of all paragraphs and all sentences of a text."""
    lines = F.split(text, "\n")
    sentences = F.filter(F.flatten(F.transform(lines, lambda p: F.split(p, r"\. "))), lambda s: s != "")
    every = F.concat(F.transform(lines, lambda p: F.xxhash64(F.lit(first), p)),
                     F.transform(sentences, lambda s: F.xxhash64(F.lit(first + 1), s)))
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(every)


def _add(a: Column, b: Column) -> Column:
    return (a + b).bitwiseAND(F.lit(MODULUS))


def _sums(hashes: Column) -> Column:
    """Packed lane sums of one hash per element."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(LONGS - 1)),
        lambda j: F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: _add(
            acc, F.call_function("shiftright", h, j).bitwiseAND(F.lit(_SPREAD)))))


def with_vector(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """``df`` with the fingerprint of a text as an array: the number of
    elements, then the packed lanes.  A null or empty text has no element."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (df.withColumn("_fp_a", _elements(text, 0)).withColumn("_fp_b", _elements(text, 2))
            .withColumn(out_col, F.concat(F.array(F.size("_fp_a").cast("long")), _sums(F.col("_fp_a")), _sums(F.col("_fp_b"))))
            .drop("_fp_a", "_fp_b"))


def insert(a: Column, b: Column) -> Column:
    """Fingerprint of all paragraphs of two texts, from their fingerprints."""
    return F.zip_with(a, b, _add)


def delete(a: Column, b: Column) -> Column:
    """Fingerprint ``a`` without the paragraphs of ``b``."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MODULUS)))


def as_text(vector: Column) -> Column:
    """The fingerprint as hexadecimal numbers with dots between."""
    return F.array_join(F.transform(vector, lambda x: F.lower(F.hex(x))), ".")


def _signed(vector: Column) -> Column:
    """The random-sign sums of all lanes."""
    n = vector[0]
    lanes = F.flatten(F.transform(F.slice(vector, 2, 2 * LONGS), lambda x: F.array(
        *[F.shiftright(x, i * LANE_BITS).bitwiseAND(F.lit(_LANE)) for i in range(LANES_PER_LONG)])))
    return F.transform(lanes, lambda c: (2 * c - n).cast("double"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def with_likeness(df: DataFrame, a: str, b: str, out_col: str) -> DataFrame:
    """Likeness (0 to 1) of two fingerprints: twice the shared elements over
    all elements, as estimated from the lanes; 1 for equal fingerprints."""
    x, y = F.col("_like_a"), F.col("_like_b")
    both = _dot(x, x) + _dot(y, y)
    return (df.withColumn("_like_a", _signed(F.col(a))).withColumn("_like_b", _signed(F.col(b)))
            .withColumn(out_col, F.when(F.col(a) == F.col(b), 1.0)
                        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * _dot(x, y) / both))))
            .drop("_like_a", "_like_b"))


def with_next(df: DataFrame, id_col: str, carry: list[str], hash_col: str) -> DataFrame:
    """Every row with the ``carry`` columns of the next row in ascending
    ``id_col`` (named ``next_*``); after the last comes the first.

    Rows are sorted within groups of neighbouring ids: quantile cells, cut
    again evenly where there are more rows than cells can hold.  The first row
    of the following group stands in each group as a sentinel, so one shuffle
    of the rows is all.  Ties are ordered by ``hash_col``, then the first
    carried column; rows without an id come first.
    """
    count = df.select(id_col).count()
    cells = max(1, min(CELLS, count // GROUP_ROWS))
    subs = max(1, count // (cells * GROUP_ROWS))
    shares = [i / cells for i in range(1, cells)]
    bounds = df.select(F.percentile_approx(id_col, shares).alias("b")).first().b if shares else None
    bounds = sorted(set(bounds or []))
    steps = [max(1, (b - a) // subs) for a, b in zip(bounds, bounds[1:])]
    key = F.col(id_col)
    cell = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>"), lambda b: b <= key))
    sub = F.lit(0).cast("long")
    if subs > 1 and steps:      # the two outer cells stay whole
        low, step = (F.array(*[F.lit(x) for x in xs]).cast("array<bigint>") for xs in (bounds[:-1], steps))
        inner = (F.col("_cell") > 0) & (F.col("_cell") <= len(steps))
        at = F.col("_cell") - 1
        sub = F.when(inner, F.floor((key - F.get(low, at)) / F.get(step, at)).cast("long")).otherwise(sub)
    rows = df.withColumn("_cell", cell).withColumn("_sub", sub)
    first = saved(rows.groupBy("_cell", "_sub").agg(F.min(F.struct(F.col(id_col).alias("i"), F.col(hash_col).alias("h"))).alias("f")),
                  "groups")
    order = Window.orderBy("_cell", "_sub")
    whole = Window.orderBy("_cell", "_sub").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = first.select("_cell", "_sub", F.coalesce(F.lead("f").over(order), F.first("f").over(whole)).alias("n"))
    after = after.select("_cell", "_sub", F.col("n.i").alias("_i"), F.col("n.h").alias("_h"))
    after = F.broadcast(after) if first.count() <= BROADCAST_GROUPS else after
    guard = (df.join(after, F.col(id_col).eqNullSafe(F.col("_i")) & F.col(hash_col).eqNullSafe(F.col("_h")))
             .drop("_i", "_h").withColumn("_guard", F.lit(1)))
    every = rows.withColumn("_guard", F.lit(0)).unionByName(guard)
    inside = Window.partitionBy("_cell", "_sub").orderBy("_guard", id_col, hash_col, carry[0])
    for c in carry:
        every = every.withColumn(f"next_{c}", F.lead(c).over(inside))
    return every.where("_guard = 0").drop("_guard", "_cell", "_sub")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_chars``, the edited text's SHA-256, both fingerprints,
    and the likeness of the text's to the edited text's and the next text's.

    The edited text has the last ``n_chars // 2`` code points replaced by as
    many first ones of the next row's text.  A null text counts as empty;
    repeated rows are rows of their own; other columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = with_vector(docs.withColumn("hash", F.xxhash64("text")), "text", "fp")
    rows = with_next(docs, "doc_id", ["text", "fp"], "hash").drop("hash")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = (rows.withColumn("n_chars", F.char_length("text").cast("long"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                                           F.substring("next_text", F.lit(1), half))).drop("text", "next_text"))
    rows = with_vector(rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)), "edited", "edited_fp").drop("edited")
    rows = with_likeness(with_likeness(rows, "fp", "edited_fp", "near_edited"), "fp", "next_fp", "near_next")
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
                       as_text(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next")
