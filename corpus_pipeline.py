"""Corpus pipeline: quality rules, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the shared
folder and read again as the next stage's docs. All but the last return the columns of documents.

Cases: null and empty texts fail the quality rules; of rows with equal doc_id in one class one stays, in
different classes each; a row without doc_id stays if its class has no other; an empty table passes every
stage and gives no rows; other columns are carried up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import jaccard, packing, quality, secrets
from skytally.session import cut_lineage


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (operator 1)."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates (operator 2), that of the least doc_id; all rows without words."""
    key = jaccard.row_key(F.col("doc_id").cast("long"), F.col("text"))
    blank = ~F.coalesce("text", F.lit("")).rlike("[^ \\t\\n\\x0b\\f\\r]")
    chosen = jaccard.class_rows(docs).withColumnRenamed("row", "_row")
    single = docs.filter(~blank).withColumn("_row", key).join(chosen, "_row", "left_semi").dropDuplicates(["_row"])
    return single.select(docs.columns).unionByName(docs.filter(blank))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked (operator 7); n_chars follows the text."""
    masked = secrets.redact_secrets(docs, secrets.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences (operator 6)."""
    return packing.pack_documents(docs, packing.word_tokens(F.col("text")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

# The secret network is trained, so SQL cannot give run()'s rows; tests use a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
