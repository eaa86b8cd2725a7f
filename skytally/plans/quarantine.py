"""Rows and files a load sets aside: classified in the load's own pass and kept with their content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.functions import records as R
from skytally.schemas import QUARANTINE
from skytally.sources.payloads import try_parsed
from skytally.sources.tables import conform, drop_partition, put, read_table

# Reasons.
BAD_JSON = "bad_json"  # the file is no JSON
NO_RECORDS = "no_record_list"  # JSON, but neither an object nor a list
NOT_AN_OBJECT = "not_an_object"  # a record that is no JSON object
INVALID_KEY = "invalid_key"  # a record without the fields of its key
MISSING_COLUMNS = "missing_columns"  # a CSV file without required columns
EXTRA_FIELDS = "extra_fields"  # a CSV record with more values than the header has names


def classified(files: DataFrame, endpoint: str, mode: str) -> DataFrame:
    """One row per record, and per file without a usable payload: file_name, record_ix, doc, keys, is_valid,
    ``reason`` (null for valid records and for payloads that are rightly empty) and ``bad_text``.
    """
    parsed = try_parsed(files)
    payload = F.col("payload")
    usable = R.is_object(payload) | R.as_list(payload).isNotNull()
    judged = parsed.withColumn("_odd", F.when(payload.isNull(), BAD_JSON).when(~usable, NO_RECORDS)).withColumn(
        "bad_text", F.when(F.col("_odd") == NO_RECORDS, F.to_json(payload)).otherwise(F.col("bad_text")))
    keyed = R.with_keys(R.unwrap(judged, mode, keep_empty=True), endpoint)
    doc = F.col("doc")
    return keyed.withColumn(
        "reason",
        F.when(F.col("_odd").isNotNull(), F.col("_odd"))
        .when(doc.isNull() | F.col("is_valid"), F.lit(None).cast("string"))
        .when(R.is_object(doc), INVALID_KEY)
        .otherwise(NOT_AN_OBJECT),
    ).drop("_odd")


def rejected_records(rows: DataFrame) -> DataFrame:
    """What of :func:`classified` rows is set aside, with its content as text."""
    content = F.coalesce("bad_text", F.to_json("doc"))
    return rows.where("reason IS NOT NULL").select("file_name", "record_ix", "reason", content.alias("content"))


def load_key(load_id: Column) -> Column:
    """Folder of a load: load ids hold paths and other text that is no folder name."""
    return F.md5(load_id)


def set_aside(
    rejected: DataFrame, path: str, source: str | Column, endpoint: str | Column, load_id: Column
) -> None:
    """Keep rejected rows; a load that is repeated replaces what it set aside before."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    rows = rejected.withColumns({
        "source": as_column(source), "endpoint": as_column(endpoint), "load_id": load_id,
        "load_key": load_key(load_id), "set_aside_at": F.current_timestamp(),
    })
    put(conform(rows, QUARANTINE), path, ("load_key",))


def forget(spark: SparkSession, path: str, load_ids: DataFrame) -> None:
    """Drop what the loads named in the first column had set aside; a folder each."""
    if read_table(spark, path) is None:
        return
    keys = load_ids.select(load_key(F.col(load_ids.columns[0])).alias("load_key")).distinct()
    known = quarantined(spark, path).select("load_key").distinct()
    for row in known.join(keys, "load_key", "left_semi").toLocalIterator():
        drop_partition(spark, f"{path}/load_key={row[0]}")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, QUARANTINE)


def reasons(rows: DataFrame) -> DataFrame:
    """Rows and files set aside by reason."""
    return rows.groupBy("endpoint", "reason").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("file_name").alias("files"))
