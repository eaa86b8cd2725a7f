"""Historical flight, trajectory-point and airport CSVs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.scalars import clean_text, to_number
from skytally.schemas import POINTS
from skytally.sources.payloads import list_files

# Airport code columns in order of precedence.
CODE_COLUMNS = ["iata_code", "icao_code", "gps_code", "ident"]
AIRPORT_COLUMNS = ["iso_country", *CODE_COLUMNS, "latitude_deg", "longitude_deg"]


def _clean_name(name: str) -> str:
    try:
        name = name.encode("latin1").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        pass
    return name.replace("\ufeff", "").strip()


def utf8_or_latin1(column: Column) -> Column:
    """Text scanned as Latin-1 (which keeps every byte) read as UTF-8 where the bytes allow it."""
    as_utf8 = F.try_validate_utf8(F.encode(column, "ISO-8859-1").cast("string"))
    return F.when(column.rlike(r"[^\x00-\x7F]"), F.coalesce(as_utf8, column)).otherwise(column)


CSV_OPTIONS = {"header": True, "encoding": "ISO-8859-1"}


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file; reads its first line only."""
    return tuple(spark.read.options(**CSV_OPTIONS).csv(path).columns)


SPLIT_BYTES = 128 << 20


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that is not empty, if the split begins its file; the rest is not read."""
    for batch in batches:
        for row, line in enumerate(batch.column("value").to_pylist()):
            if batch.column("start")[row].as_py():
                return
            if line and line.strip():
                yield batch.slice(row, 1)
                return


def headers(spark: SparkSession, folder: str, pattern: str) -> dict[tuple[str, ...], list[str]]:
    """Column names → paths of the CSVs below a folder: a listing, one job for all first lines and one per
    distinct header, whatever the number of files.

    Every split of a file is a partition of its own, and a task stops at its first batch of lines. Files
    without a line have no names.
    """
    lone = spark.newSession()
    for conf in ("maxPartitionBytes", "openCostInBytes"):  # an open file fills a partition
        lone.conf.set(f"spark.sql.files.{conf}", str(SPLIT_BYTES))
    paths = {row.url: row.path for row in list_files(spark, folder, pattern, recursive=True, with_url=True).collect()}
    if not paths:
        return {}
    text = (
        lone.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        .option("lineSep", "\n").text(folder)
    )
    # Raw bytes: which encoding a line has shows only later.
    lines = text.select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
    ).mapInArrow(_first_line, "value binary, path string, start long")
    found: dict[bytes, list[str]] = {}
    for row in lines.collect():  # a row a file, in one job
        found.setdefault(bytes(row.value), []).append(paths.pop(row.path))
    groups: dict[tuple[str, ...], list[str]] = {(): list(paths.values())} if paths else {}
    for line, held in found.items():
        first = spark.sparkContext.parallelize([line.decode("latin-1").rstrip("\r")], 1)
        names = tuple(spark.read.option("header", True).csv(first).columns)
        groups.setdefault(names, []).extend(held)
    return {names: sorted(held) for names, held in groups.items()}


EXTRA = "_extra_fields"  # the raw record, where it has more values than the header has names


def _scan_text(
    spark: SparkSession, paths: list[str] | str, names: tuple[str, ...], mark_extra: bool = False
) -> DataFrame:
    """Headed CSVs with a known header as text columns, UTF-8 or Latin-1; no inference pass."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader, marks = spark.read.options(**CSV_OPTIONS), []
    if mark_extra:
        # A reader of all columns marks records of another length; short ones are filled with nulls as they always are.
        wider = T.StructType([*schema, T.StructField(EXTRA, T.StringType())])
        # Spark refuses to read the mark alone, so it takes no character of the first column along.
        raw = F.concat(F.col(EXTRA), F.substring(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), 1, 0))
        beyond = F.from_csv(raw, f"{wider.toDDL()}")[EXTRA]
        marks = [F.when(raw.isNotNull() & beyond.isNotNull(), utf8_or_latin1(raw)).alias(EXTRA)]
        rows = reader.options(columnNameOfCorruptRecord=EXTRA, columnPruning=False).schema(wider).csv(paths)
    else:
        rows = reader.option("enforceSchema", False).schema(schema).csv(paths)
    return rows.select(
        [utf8_or_latin1(F.col(f"`{n}`")).alias(_clean_name(n)) for n in names] + marks
        + [F.col("_metadata.file_path").alias("source_file")]
    )


def scan_history(
    spark: SparkSession, folder: str, required: list[str] | None = None, mark_extra: bool = False
) -> tuple[DataFrame | None, dict[str, list[str]]]:
    """Every ``Flights_*.csv`` below the folder as text columns plus ``source_file``.

    Files are grouped by header: one scan per distinct header, whatever the number of files. Files
    that lack a required column are returned with the missing names instead of being scanned. With
    ``mark_extra`` a column ``EXTRA`` holds the raw text of records with more values than the header.
    """
    rejected: dict[str, list[str]] = {}
    groups = headers(spark, folder, "Flights_*.csv")
    for names in list(groups):
        missing = sorted(set(required or []) - {_clean_name(n) for n in names})
        if missing or not names:
            rejected.update(dict.fromkeys(groups.pop(names), missing))
    scans = [_scan_text(spark, paths, names, mark_extra) for names, paths in groups.items()]
    if not scans:
        return None, rejected
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans), rejected


def scan_points(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``Flight_Points_Filed_*.csv`` below the folder, typed by contract.

    Files are grouped by header, so each is read by its own column order.
    """
    groups = headers(spark, folder, "Flight_Points_Filed_*.csv")
    groups.pop((), None)
    scans = [
        _scan_text(spark, paths, names).select(
            [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in POINTS])
        for names, paths in groups.items()
    ]
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], POINTS)


def scan_airports(spark: SparkSession, path: str) -> DataFrame:
    """Airport rows with the file order in ``row_ix``; no rows when the file is missing."""
    try:
        raw = _scan_text(spark, path, _header(spark, path))
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        empty = ", ".join(f"{c} string" for c in AIRPORT_COLUMNS)
        return spark.createDataFrame([], f"row_ix bigint, {empty}")
    # monotonically_increasing_id grows with the split order of one file, which is all E4 needs.
    return raw.select(F.monotonically_increasing_id().alias("row_ix"), *AIRPORT_COLUMNS)


def airport_coordinates(airports: DataFrame, country: str = "FR") -> DataFrame:
    """code → (latitude, longitude) for one country; the first row and code column win.

    ``min_by`` keeps the first mapping per code with a map-side combine; no per-code sort.
    """
    codes = [c for c in CODE_COLUMNS if c in airports.columns]
    valid = airports.where(
        (F.col("iso_country") == country) & F.col("iata_code").isNotNull()
    ).select(
        "row_ix",
        to_number(F.col("latitude_deg")).alias("latitude"),
        to_number(F.col("longitude_deg")).alias("longitude"),
        F.posexplode(F.array(*[clean_text(F.col(c), upper=True) for c in codes])).alias(
            "col_ix", "code"
        ),
    ).where("latitude IS NOT NULL AND longitude IS NOT NULL AND code IS NOT NULL")
    first = F.min_by(F.struct("latitude", "longitude"), F.struct("row_ix", "col_ix"))
    return valid.groupBy("code").agg(first.alias("c")).select("code", "c.latitude", "c.longitude")
