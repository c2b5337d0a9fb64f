"""A training-data pipeline over ``documents``.

``STAGES`` lists its stages in order; each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.

Null or empty texts pass the first three stages (nothing speaks against
them), are not drawn by the mix, and so do not reach the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import decontam, mixing, ngram_join, sharding, toxicity
from souk.llm.common import drop_saved, held_out, saved

SHARDS = 40
SIGNATURE_SLICES = 2          # the signatures of the near-copy join are more bytes than the texts: shuffled in halves
BROADCAST_ROWS = 1_000_000    # row numbers (8 bytes each) that may be broadcast; checked by a count
ROW = "_pipeline_row"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number per row: an id may stand on several rows, or on none.
    The numbers of a stored table are the same in every read."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The numbered ``rows`` without those whose number is in ``gone``."""
    gone = saved(gone.select(ROW).distinct(), "gone")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return rows.join(gone, ROW, "left_anti").drop(ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go.  Labels of held-out rows are not learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    scorer = toxicity.train(toxicity.training_sample(docs, labels))
    return (toxicity.score_texts(docs, scorer, out_col="_toxicity")
            .where(F.col("_toxicity") < toxicity.THRESHOLD).select(docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every group of near duplicates (5-word shingles,
    similarity 0.8): that of the smallest id.  Rows are judged one by one, so of a
    repeated row one stays and an id on two texts loses neither for the other's sake."""
    rows = _numbered(docs)
    groups = ngram_join.near_duplicates(rows, n=5, similarity=80, id_col=ROW, slices=SIGNATURE_SLICES).select(F.col("doc_id").alias(ROW), "component_id")
    with_id = saved(groups.join(rows.select(ROW, "doc_id"), ROW), "groups")
    first = with_id.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("k")).select(F.col(f"k.{ROW}").alias(ROW))
    return _without(rows, with_id.join(first, ROW, "left_anti"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go."""
    rows = _numbered(docs)
    found = decontam.contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=ROW)
    return _without(rows, found.select(F.col("doc_id").alias(ROW)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as a mix of the sources (weights 5, 2, 1, ...) draws them."""
    return mixing.mixed(docs)


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``shard`` (of 40, nearly equal bytes) and ``slot``."""
    return sharding.sharded(docs, SHARDS).select(*docs.columns, "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", into_shards),
]

ORACLE_SQL = None       # trained models, signatures and seeded draws are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each stage's rows are stored
    in the shared folder and deleted once the next stage's are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop_saved(spark, before)
        before = docs
    return docs
