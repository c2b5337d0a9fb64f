"""Raw landing zone.

Layout: ``{base}/{entity}/folder_dt=YYYY-MM-DD/part-*.json.gz`` with one JSON
record per line; JSON repeats its field names in every record, so the files are
gzipped, and hold a bounded number of records, as such a file is read by one
task.  Plain ``.json`` files are read too; a source that lands one array per file under
``dt=`` is read with ``Layout(multiline=True, folder="dt")``.  Orders are a
daily partition; sellers and products are full daily snapshots, read from the
latest folder up to ds, which is found by listing folders.

Staging (C1) reads every field as text and casts with ``try_cast``.  What
cannot be staged is a reject row with its reason: a malformed value, an
unparsable line, a record without ``dt`` or under another date's folder (Q8).
Staged rows and rejects together are all landed records.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk import schemas as S
from souk.functions.dates import in_dates
from souk.operators.sinks import list_partitions, write_partitions

RECORDS_PER_FILE = 1_000_000    # of a landed file; a date has as many files as it needs
ENTITY_SCHEMAS = {"orders": S.ORDERS, "sellers": S.SELLERS, "products": S.PRODUCTS}


def text_schema(schema: T.StructType) -> T.StructType:
    """Same field names, every field read as its JSON text."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def land(df: DataFrame, base: str, entity: str, ds=None, spread: list[str] | None = None,
         n_dates: int | None = None) -> None:
    """B1: write records as JSON lines under ``entity/folder_dt=``, replacing those dates.

    The folder date is ``df.folder_dt`` when present, else ``ds`` (daily
    snapshots), else the record's own ``dt``.  The record keeps its ``dt``
    field, so a record filed under the wrong date can be detected (Q8).
    """
    rows = df
    if "folder_dt" not in rows.columns:
        folder = F.lit(str(ds)).cast("date") if ds is not None else F.col("dt")
        rows = rows.withColumn("folder_dt", folder)
    write_partitions(rows, f"{base}/{entity}", part="folder_dt", spread=spread, fmt="json", n_values=n_dates,
                     options={"compression": "gzip", "maxRecordsPerFile": str(RECORDS_PER_FILE)})


class Layout(NamedTuple):
    """How an entity lies in the landing zone."""

    multiline: bool = False          # one JSON array per file
    folder: str = "folder_dt"        # name of the date folders


CORRUPT = "_corrupt_record"
SOURCE = "source_file"
MANY_DAYS = 64                  # from so many folders on, a read of most of them lists the entity's root once


def read_raw(spark: SparkSession, base: str, entity: str, ds=None, as_text: bool = False,
             multiline: bool = False, dates=None, layout: Layout | None = None) -> DataFrame:
    """A1-A3: raw records of ``entity`` for one date, a set of dates, or all.

    The folder date comes from the file's path as ``path_dt``, apart from the
    record's own ``dt``, so both are kept.  With dates only their folders are
    opened.  As text, an unparsable line keeps its text in ``_corrupt_record``.
    """
    layout = layout or Layout(multiline)
    schema = ENTITY_SCHEMAS[entity]
    fields = (text_schema(schema) if as_text else schema).fields
    if as_text:
        fields = [*fields, T.StructField(CORRUPT, T.StringType())]
    root = f"{base}/{entity}"
    days = landed_days(spark, base, entity, layout)
    n_landed = len(days)
    if ds is not None or dates is not None:
        wanted = {str(d) for d in ([ds] if ds is not None else dates)}
        days = [d for d in days if d in wanted]
    if not days:
        extra = [T.StructField("path_dt", T.DateType())] + ([T.StructField(SOURCE, T.StringType())] if as_text else [])
        return spark.createDataFrame([], T.StructType([*fields, *extra]))
    reader = spark.read.schema(T.StructType(fields)).option("multiLine", str(layout.multiline).lower())
    if as_text:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    day = F.regexp_extract(F.col("_metadata.file_path"), rf"/{layout.folder}=(\d{{4}}-\d{{2}}-\d{{2}})/", 1).cast("date")
    file = [F.col("_metadata.file_path").alias(SOURCE)] if as_text else []
    if len(days) > MANY_DAYS and 2 * len(days) > n_landed:
        # one root, listed in parallel; its folder names add no column beside the record's dt
        with listing_tasks(spark):
            found = reader.option("recursiveFileLookup", "true").json(root).select("*", day.alias("path_dt"), *file)
        return found if len(days) == n_landed else found.where(in_dates("path_dt", days))
    # each folder is a root of its own, so its name adds no column beside the record's dt
    return reader.json([f"{root}/{layout.folder}={d}" for d in days]).select("*", day.alias("path_dt"), *file)


@contextmanager
def listing_tasks(spark: SparkSession):
    """List folders with a few tasks per core; by default it is a task per folder."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def landed_days(spark: SparkSession, base: str, entity: str, layout: Layout | None = None) -> list[str]:
    """Dates that have a folder, by listing (no file is opened)."""
    return list_partitions(spark, f"{base}/{entity}", (layout or Layout()).folder)


def latest_snapshot_date(spark: SparkSession, base: str, entity: str, ds, layout: Layout | None = None) -> str | None:
    """Latest folder date up to ``ds`` of a snapshot entity."""
    return max((d for d in landed_days(spark, base, entity, layout) if d <= str(ds)), default=None)


def read_snapshot_raw(spark: SparkSession, base: str, entity: str, ds, as_text: bool = False,
                      layout: Layout | None = None) -> DataFrame:
    """A2/A3: the full snapshot of sellers/products as of ``ds``."""
    return read_raw(spark, base, entity, dates=[latest_snapshot_date(spark, base, entity, ds, layout)], as_text=as_text, layout=layout)


def stage(raw_text: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """Typed projection of text records -> (typed rows, rejects with a reason)."""
    marked = marked_rows(raw_text, entity)
    good = marked.where(F.col("reject_reason") == "").select(*ENTITY_SCHEMAS[entity].fieldNames())
    return good, marked.where(F.col("reject_reason") != "").select("raw", "reject_reason")


def marked_rows(raw_text: DataFrame, entity: str) -> DataFrame:
    """Every record typed, with ``reject_reason`` ('' if it can be staged) and its text."""
    schema = ENTITY_SCHEMAS[entity]
    has = set(raw_text.columns)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    checks = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
                     F.lit(f"bad {f.name}")) for f in schema.fields]
    text = F.to_json(F.struct(*[F.col(f.name) for f in schema.fields]))
    if CORRUPT in has:
        checks.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("not a record")))
        text = F.coalesce(F.col(CORRUPT), text)
    if entity == "orders" and "path_dt" in has:
        other = F.col("dt").isNull() | (F.col("dt").try_cast("date") != F.col("path_dt"))
        if CORRUPT in has:
            other = other & F.col(CORRUPT).isNull()
        checks.append(F.when(other, F.lit("dt differs from folder")))
    kept = [c for c in (SOURCE, "path_dt") if c in has]
    return raw_text.select(*typed, F.concat_ws("; ", *checks).alias("reject_reason"), text.alias("raw"), *kept)
