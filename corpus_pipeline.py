"""The corpus pipeline: each stage takes all that the one before kept.

Reject low quality, keep one of each group of near copies, drop contaminated
documents, redact secrets, and encode.  Between stages the documents are a
Parquet table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import byte_bpe, decontaminate, jaccard_join, kn_quality, secrets
from tallyspark.llm.common import save, scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney classifier keeps."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return kn_quality.keep_good(docs.select(*COLUMNS), labels)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least id, and of its texts the least by a hash) of each
    component of texts whose sets of five-word shingles are similar by 0.8 or more."""
    # rows of one id can have different texts: each is a row of its own here; null ids name no component and stay
    keyed = docs.select(*COLUMNS, F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"))).alias("row_"))
    first = jaccard_join.component_ids(keyed, id_col="row_", k=5, percent=80).where("component_id = row_").select("row_").distinct()
    kept = keyed.join(first, "row_", "left_semi").dropDuplicates(["row_"])
    return kept.select(*COLUMNS).union(docs.select(*COLUMNS).where("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean_documents(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in them replaced; n_chars counts the new text."""
    scanned = secrets.scan_documents(docs.select(*COLUMNS), scratch_path(spark, "secret-ledger"))
    found = F.size("findings") > 0
    out = secrets.redact(scanned)
    return out.withColumn("n_chars", F.when(found, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every document."""
    import public_tokenizers
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.digests(docs, path, pattern)


STAGES = [("quality_classifier", quality), ("ngram_jaccard_join", near_copies), ("benchmark_decontamination", decontaminated),
          ("secret_scans", without_secrets), ("byte_level_bpe", encoded)]

#: Statistics of trained models and iterated links: no SQL.  The stages after the classifier are tested row by row against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
