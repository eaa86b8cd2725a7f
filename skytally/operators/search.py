"""Row filters and searches."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.records import text_at

# Identifier columns looked at by each search, in order.
SQL_ID_COLUMNS = ["flight_iata", "flight_icao", "flight_number", "iata", "icao", "number"]
MASK_ID_COLUMNS = [
    "flight.iata", "flight.icao", "flight.number", "flight_number", "iata", "icao", "number",
]
DOCUMENT_ID_PATHS = [
    "flight.iata", "flight.icao", "flight.number", "flight_iata", "flight_icao", "flight_number",
]


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def check_limit(limit: int, low: int, high: int) -> int:
    if not low <= limit <= high:
        raise ValueError(f"limit must be between {low} and {high}")
    return limit


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def first_existing_column(df: DataFrame, candidates: list[str]) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def option_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values for a filter list."""
    return (
        df.where(quoted(column).isNotNull())
        .select(quoted(column).cast("string").alias("option"))
        .distinct()
        .orderBy("option")
    )


def keep_selected(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(quoted(column).cast("string").isin(values))


def keep_delay_status(df: DataFrame, status: str = "all") -> DataFrame:
    """``all``, ``delayed`` or ``on_time``; an unknown delay is in neither of the last two."""
    if status == "delayed":
        return df.where("is_delayed")
    if status == "on_time":
        return df.where("NOT is_delayed")
    if status != "all":
        raise ValueError(f"unknown delay status {status!r}")
    return df


def any_column_matches(df: DataFrame, pattern: str) -> DataFrame:
    """Rows where some column as text matches the regex, case-insensitively."""
    texts = F.array(*[quoted(c).cast("string") for c in df.columns])
    hit = F.exists(texts, lambda t: F.coalesce(t.rlike(f"(?i){pattern}"), F.lit(False)))
    return df.where(hit)


def like_any_id(df: DataFrame, text: str) -> DataFrame:
    """ILIKE ``%text%`` over the identifier columns the table has; ``%`` and ``_`` stay wildcards."""
    columns = [c for c in SQL_ID_COLUMNS if c in df.columns]
    if not columns:
        raise ValueError(f"no searchable identifier column, expected one of {SQL_ID_COLUMNS}")
    pattern = f"%{text.strip()}%"
    return df.where(any_of([quoted(c).cast("string").ilike(pattern) for c in columns]))


def documents_matching(docs: DataFrame, pattern: str, doc: str = "doc") -> DataFrame:
    """Documents with an identifier that matches the regex, case-insensitively."""
    regex = f"(?i){pattern.strip()}"
    return docs.where(
        any_of([
            F.coalesce(text_at(F.col(doc), p).rlike(regex), F.lit(False)) for p in DOCUMENT_ID_PATHS
        ])
    )


def contains_text(df: DataFrame, text: str) -> DataFrame:
    """Literal substring over the identifier columns, over every column when there are none."""
    if not text:
        return df.where(F.lit(False))
    needle = text.strip().lower()
    columns = [c for c in MASK_ID_COLUMNS if c in df.columns] or df.columns
    return df.where(
        any_of([
            F.coalesce(F.lower(quoted(c).cast("string")).contains(needle), F.lit(False))
            for c in columns
        ])
    )
