"""Parquet tables: create, read, append, replace touched partitions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.operators.joins import with_computed
from skytally.session import cut_lineage
from skytally.sources.table_schemas import keep_schema, stored_schema


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table, or an empty one of ``schema`` (None without a schema) when nothing is there.

    Without a schema the table's stored one is used; footers are merged only where a table has none.
    """
    try:
        wanted = schema if schema else stored_schema(spark, path)
        if wanted is not None:  # partition columns outside the contract are left out
            return spark.read.schema(wanted).parquet(path).select([F.col(f"`{n}`") for n in wanted.names])
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as missing:
        if not any(code in str(missing) for code in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            raise
    return spark.createDataFrame([], schema) if schema else None


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: tuple[str, ...] = ()
) -> DataFrame:
    if read_table(spark, path) is None:
        empty = spark.createDataFrame([], schema)
        writer = empty.write.mode("ignore")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return read_table(spark, path, schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the contract in its order; absent ones are null, others are dropped."""
    have = set(df.columns)
    return df.select([
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def put(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Write rows and keep the table's schema up with them.

    ``overwrite`` replaces the partitions the rows are in, or the whole of a table without partitions.
    """
    spark = df.sparkSession
    if partition_by or mode == "append":
        keep_schema(spark, path, df.schema)
        if partition_by:
            # REBALANCE splits a hot partition over several files and merges small ones.
            df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
        writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    else:
        df.write.mode(mode).parquet(path)
        keep_schema(spark, path, df.schema)


def replace_partitions(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (), checkpointed: bool = False
) -> DataFrame:
    """Overwrite the partitions ``df`` holds (the whole table when there are none).

    ``df`` is usually computed from the same table, so it is checkpointed first unless it has been;
    the files that were read may then be replaced. Returns the checkpointed rows for further use.
    """
    done = df if checkpointed else cut_lineage(df)
    put(done, path, partition_by)
    return done


def drop_partition(spark: SparkSession, folder: str) -> None:
    """Delete one partition folder of a table in whatever store it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def touched(table: DataFrame, batch: DataFrame, column: str, max_values: int = 5_000) -> DataFrame:
    """Rows of the table whose partition ``column`` occurs in the batch.

    A batch touches a few days or runs; their literals prune partitions when the query is planned.
    Beyond ``max_values`` a semi-join does the same without bringing values to the driver.
    """
    values = batch.select(column).distinct()
    found = [row[0] for row in values.limit(max_values + 1).collect()]
    if len(found) > max_values:
        return table.join(values, table[column].eqNullSafe(values[column]), "left_semi")
    listed = table[column].isin([v for v in found if v is not None])
    return table.where(listed | table[column].isNull() if None in found else listed)


def append_csv(spark: SparkSession, csv_path: str, table_path: str) -> int:
    """Bulk append of a headed CSV as text columns; loading the same file again replaces its rows.

    Files are told apart by their whole path, and may differ in their columns.
    """
    if not csv_path.endswith(".csv"):
        raise ValueError("only .csv files can be loaded")
    rows = spark.read.option("header", True).csv(csv_path)
    if not rows.columns:
        raise ValueError("the CSV file is empty")
    key = F.concat(F.lit("f"), F.md5(F.lit(csv_path)))
    rows = rows.toDF(*[c.strip() for c in rows.columns]).withColumns({"source_file": F.lit(csv_path), "source_key": key})
    put(rows, table_path, ("source_key",))
    return read_table(spark, table_path).where(F.col("source_key") == key).count()


def scan_training(table: DataFrame, columns: list[str]) -> DataFrame:
    """Column-pruned read of the training columns."""
    missing = sorted(set(columns) - set(table.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return table.select([F.col(f"`{c}`") for c in columns])


def scan_training_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], **options) -> DataFrame:
    return scan_training(spark.read.jdbc(url, table, properties=options), columns)


def scan_documents(table: DataFrame, limit: int, order: list[str] | None = None) -> DataFrame:
    """First N documents; ordered by the given columns so that repeated reads agree."""
    return (table.orderBy(*order) if order else table).limit(limit)


def field_text(df: DataFrame, path: str) -> Column | None:
    """Text of a dotted path in struct or VARIANT columns, None when the table has no such column."""
    head, _, rest = path.partition(".")
    if head not in df.columns:
        return None
    dtype = df.schema[head].dataType
    if isinstance(dtype, T.VariantType):
        return F.try_variant_get(head, F.lit("$." + rest if rest else "$"), "string")
    if rest and (not isinstance(dtype, T.StructType) or rest not in dtype.fieldNames()):
        return None
    return F.col(path).cast("string")


# Recency columns in order of preference.
RECENCY_PATHS = ["_meta.loaded_at", "ingested_at", "created_at", "flight_date", "departure.scheduled"]


def scan_recent(table: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest documents by the first recency column the table has; all of them without a limit."""
    if not limit:
        return table
    recency = next((c for c in (field_text(table, p) for p in RECENCY_PATHS) if c is not None), None)
    if recency is not None:
        table = table.orderBy(recency.desc_nulls_last())
    return table.limit(limit)


def as_documents(table: DataFrame) -> DataFrame:
    """Document table rows with the whole record as VARIANT in ``doc``."""
    return with_computed(table, {"doc": F.to_variant_object(F.struct("*"))})
