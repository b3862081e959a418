"""The corpus pipeline: quality rules, line dedup, near dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; the driver of
the pipeline writes each result as Parquet and reads it again. All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import decontam, line_dedup, mixing, quality, simhash
from sparkloom.llm.common import table
from sparkloom.storage import scratch, table_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or whose n-gram ratio is below the threshold."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality.keep(docs, quality.fit(docs, trusted))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that many documents share; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, numbered by copy."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
]

#: Hashed n-grams, XXH64 fingerprints and components have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = table_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        with scratch(spark):  # what a stage keeps aside goes once its result is written
            stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
