"""The thin queries over the benchmark tables: ``opN_<name>``.

Each applies its operator with production parameters to the whole of its
table.  ``ORACLE`` holds DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import (decontam, fingerprint, langid, licenses, lines, mixing, ngram_join, oracle, ranked_search, sharding, spelling,
                      token_counts, token_files, toxicity)
from souk.llm.common import held_out


TOKEN_LIMIT = 4_096
END_ID = 2


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources with weights 5, 2, 1, ... takes of every document."""
    return mixing.taken(_docs(spark, sf_dir))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards of nearly equal bytes; documents with equal texts share one."""
    return (sharding.sharded(_docs(spark, sf_dir), 40)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of held-out rows are not learned from."""
    docs, labels = _docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scorer = toxicity.train(toxicity.training_sample(docs, labels.where(~held_out(F.col("doc_id")))))
    return (toxicity.score_texts(docs.select("doc_id", "text"), scorer)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, read back from the shard files through the index."""
    import public_tokenizers
    return token_files.round_trip(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), END_ID)


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint.edited_fingerprints(_docs(spark, sf_dir))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; held-out rows are not learned from."""
    docs = _docs(spark, sf_dir)
    tagger = langid.train(langid.training_texts(docs.where(~held_out(F.col("doc_id")))))
    return (langid.with_language(docs.select("doc_id", "text"), tagger)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-equal lines over all documents."""
    return lines.line_groups(_docs(spark, sf_dir))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingle sets are at least 90 % alike."""
    return ngram_join.near_duplicates(_docs(spark, sf_dir), n=3, similarity=90)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document with a public sentencepiece model."""
    import public_tokenizers
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    return (token_counts.with_token_count(docs, public_tokenizers.path("piece_bpe_32k.model"))
            .select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
                    (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, one row per document and item."""
    return decontam.contaminated(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and statements in every document."""
    return licenses.scan(_docs(spark, sf_dir))[0]


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent word that they are one edit from."""
    return spelling.variant_forms(spelling.run_counts(_docs(spark, sf_dir)))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every benchmark item."""
    return ranked_search.top_documents(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_sharding": op2_sharding,
    "op3_toxicity": op3_toxicity,
    "op4_token_files": op4_token_files,
    "op5_fingerprint": op5_fingerprint,
    "op6_language": op6_language,
    "op7_line_dedup": op7_line_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_licenses": op11_licenses,
    "op12_spelling": op12_spelling,
    "op13_ranked_search": op13_ranked_search,
}
ORACLE: dict[str, str] = oracle.ORACLE
