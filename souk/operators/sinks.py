"""Writes: partition replace, upsert, insert-if-absent, generated ids.

Stored tables are those of ``souk.operators.store``: runs of Parquet files and a
commit log; a job that fails leaves a table as it was, and running it again
gives the same table.  The functions here work on one table at a path of its
own; the jobs of ``souk.plans.pipeline`` change several tables in one commit.
The landing zone is plain: one folder per date, written by dynamic overwrite.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.operators.store import Store, folder_names


# --- frame-level operators -------------------------------------------------

def upsert_frame(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """B3 on frames: source rows replace target rows with the same key; others kept.

    Of a key that occurs twice in the source one row is taken, the greatest by
    its other columns, so the result has one row per key whatever the order.
    """
    cols = target.columns
    source = one_per_key(source.select(*cols), keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*cols).unionByName(source.select(*cols))


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The greatest row of every key by the other columns, in their order; a
    map-side combined aggregate, so a key with very many copies is no burden."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_b"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_b.{c}").alias(c) for c in df.columns])


def insert_absent(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """B4 on frames: add source rows whose key is not in the target (DO NOTHING)."""
    cols = target.columns
    fresh = one_per_key(source.select(*cols), [key]).join(target.select(key), key, "left_anti")
    return target.unionByName(fresh.select(*cols))


# --- the landing zone ----------------------------------------------------

# Folders one write task targets at most when the number of dates is known.
FOLDERS_PER_TASK = 64


def _layout(df: DataFrame, part: str, spread: list[str] | None, n_values: int | None = None) -> DataFrame:
    """Range-partition on (partition column, spread columns) before a write.

    Range boundaries come from a sample, so one huge date is cut into
    several tasks while each task still writes few partition folders.  The
    task count is at least the session's shuffle partitions (the cluster's
    size knob) and at least one task per ``FOLDERS_PER_TASK`` target dates,
    so a backfill of many small dates is not squeezed into one writer.
    """
    cols = [F.col(part)] + [F.col(c) for c in (spread or [])]
    if n_values is None:
        return df.repartitionByRange(*cols)
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    n = max(base, -(-n_values // FOLDERS_PER_TASK))
    return df.repartitionByRange(n, *cols)


def write_partitions(df: DataFrame, path: str, part: str = "dt", spread: list[str] | None = None,
                     fmt: str = "parquet", n_values: int | None = None, options: dict | None = None) -> None:
    """Replace exactly the ``part`` values present in ``df`` (dynamic overwrite)."""
    (_layout(df, part, spread, n_values).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").options(**(options or {}))
        .partitionBy(part).format(fmt).save(path))


def delete_paths(spark: SparkSession, paths: Iterable[str]) -> int:
    """Remove folders through the Hadoop FileSystem of each path (metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        fs = jp.getFileSystem(conf)
        if fs.exists(jp):
            fs.delete(jp, True)
            n += 1
    return n


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jp = jvm.org.apache.hadoop.fs.Path(path)
    return bool(jp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jp))


def list_partitions(spark: SparkSession, path: str, part: str) -> list[str]:
    """Values of the partition folders below ``path`` (folder names only)."""
    return sorted(n.split("=", 1)[1] for n in folder_names(spark, path) if n.startswith(f"{part}="))


# --- tables of dates ---------------------------------------------------------

TABLE = ""       # the one table of a store of its own


def current_dates(spark: SparkSession, path: str) -> dict[str, int]:
    """Date -> rows, for the dates that have rows (no file is opened)."""
    return Store(spark, path).begin().parts(TABLE)


def replace_partitions(df: DataFrame, path: str, dates: Iterable, part: str = "dt",
                       spread: list[str] | None = None) -> None:
    """B2 for a set of dates in one job: afterwards each holds exactly ``df``'s
    rows (none: it is empty).  Writers of other dates do not meet."""
    tx = Store(df.sparkSession, path).begin()
    tx.replace(TABLE, df, part, dates, df.schema, spread)
    tx.commit(blind=True)


def replace_partition(df: DataFrame, path: str, ds, part: str = "dt") -> None:
    """B2 for one date; an empty ``df`` empties it."""
    replace_partitions(df, path, [ds], part)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType, ds=None,
                     part: str = "dt", dates: Iterable | None = None) -> DataFrame:
    """A4/A5: scan a table of dates; with ``ds`` or ``dates`` only files that hold
    them are opened.  A table that was never written is empty."""
    return Store(spark, path).begin().read(TABLE, schema, [ds] if ds is not None and dates is None else dates, part)


def vacuum(spark: SparkSession, path: str, keep_seconds: float = 0) -> int:
    """Delete runs that nothing refers to; by default of any age, for times when
    no job reads the table."""
    return Store(spark, path).vacuum(keep_seconds)


def partition_row_count(spark: SparkSession, path: str, schema: T.StructType, ds) -> DataFrame:
    """Rows in the partition just written (read back, pruned)."""
    return read_partitioned(spark, path, schema, ds).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


# --- keyed tables (dimensions) -------------------------------------------------

_WHOLE = "_whole"


def current_version(spark: SparkSession, path: str) -> int | None:
    """Number of the newest commit of a keyed table."""
    return Store(spark, path).state()["seq"] or None


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The rows of a table written by the functions below; None if there is none."""
    tx = Store(spark, path).begin()
    if not tx.base:
        return None
    keys = tx.prop(TABLE, "keys")
    if keys:
        return tx.read_keyed(TABLE, schema, keys)
    return tx.read(TABLE, T.StructType([*schema.fields, T.StructField(_WHOLE, T.IntegerType())]), part=_WHOLE).select(*schema.fieldNames())


def write_snapshot(df: DataFrame, path: str) -> int:
    """Replace the whole table by ``df``; returns the version."""
    tx = Store(df.sparkSession, path).begin()
    whole = df.withColumn(_WHOLE, F.lit(0))
    tx.replace(TABLE, whole, _WHOLE, {0, *tx.parts(TABLE)}, whole.schema)
    tx.set_prop(TABLE, "keys", None)
    return tx.commit()


def _keyed(spark: SparkSession, path: str, source: DataFrame, keys: list[str], schema: T.StructType, update: bool) -> int:
    tx = Store(spark, path).begin()
    if tx.prop(TABLE, "keys") != keys:                     # written whole before: bucket it by its key first
        before = read_snapshot(spark, path, schema)
        for p in tx.parts(TABLE):
            tx._change(TABLE, replace={p: []})
        tx.set_prop(TABLE, "keys", keys)
        if before is not None:
            tx.upsert(TABLE, before, keys, schema)
    tx.upsert(TABLE, source, keys, schema, update)
    return tx.commit()


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: list[str],
                 schema: T.StructType) -> int:
    """B3 on storage: rows with a new key are added, changed rows replaced; only
    buckets of these keys are opened and written.  Returns the version."""
    return _keyed(spark, path, source, keys, schema, True)


def insert_absent_table(spark: SparkSession, path: str, source: DataFrame, key: str,
                        schema: T.StructType) -> int:
    """B4 on storage: rows with unseen keys are added."""
    return _keyed(spark, path, source, [key], schema, False)


# --- generated columns (B5) ------------------------------------------------

def sequential_id(df: DataFrame, order: list, id_col: str = "id") -> DataFrame:
    """Dense ids 1..N following the total order ``order`` (stand-in for SERIAL).

    No global single-task window: rows are range-partitioned on ``order``
    (sampled boundaries, balanced even when one date holds most rows) and
    STORED with their range number; counts and numbers are then both taken
    from the stored rows, so they cannot differ.  A range's offset is the row
    count of the ranges before it: one row per range.
    """
    from souk.session import shared_dir

    spark = df.sparkSession
    order = [F.col(c) if isinstance(c, str) else c for c in order]   # names or sort expressions
    path = shared_dir(spark, "ranges")
    df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_pid", T.IntegerType())])).parquet(path)
    before = Window.orderBy("_pid")
    offsets = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).select(
        "_pid", (F.sum("_n").over(before) - F.col("_n")).alias("_off"))
    inside = Window.partitionBy("_pid").orderBy(*order)
    return (stored.withColumn("_ix", F.row_number().over(inside)).join(offsets, "_pid")
                  .withColumn(id_col, (F.col("_off") + F.col("_ix")).cast("bigint"))
                  .drop("_pid", "_ix", "_off"))
