"""Punctuality report over the typed history (operator, aircraft_type, origin, destination, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skytally.functions.scalars import (
    DAYS, HOUR_BUCKETS, day_name, hour_bucket, monday_based_weekday, parse_history_timestamp,
    route_label,
)
from skytally.operators.search import keep_delay_status


def with_calendar(history: DataFrame) -> DataFrame:
    """Hour, weekday and 3-hour bucket of the filed departure (text or timestamp)."""
    filed = F.col("filed_dep_time")
    if dict(history.dtypes)["filed_dep_time"] == "string":
        filed = parse_history_timestamp(filed)
    return history.withColumn("filed_dep_time", filed).withColumns({
        "hour": F.hour("filed_dep_time"),
        "day_name": day_name(F.col("filed_dep_time")),
        "day_of_week": monday_based_weekday(F.col("filed_dep_time")),
        "hour_group": hour_bucket(F.hour("filed_dep_time")),
    })


def filtered(
    history: DataFrame,
    operators: list[str] | None = None,
    aircraft_types: list[str] | None = None,
    status: str = "all",
) -> DataFrame:
    """Multi-select filters; None keeps every non-null value, as a full selection does."""
    for column, chosen in (("operator", operators), ("aircraft_type", aircraft_types)):
        condition = F.col(column).isNotNull() if chosen is None else F.col(column).isin(chosen)
        history = history.where(condition)
    return keep_delay_status(history, status)


def _rate(delayed, total):
    return F.when(total > 0, 100.0 * delayed / total).otherwise(0.0)


def _status(delayed="is_delayed"):
    return F.when(F.col(delayed), "Delayed").otherwise("On-Time").alias("status")


def kpis(history: DataFrame) -> DataFrame:
    total, delayed = F.count(F.lit(1)), F.count_if("is_delayed")
    late = F.avg(F.when(F.col("is_delayed"), F.col("delay_minutes")))
    return history.agg(
        total.alias("total_flights"),
        delayed.alias("delayed_flights"),
        (total - delayed).alias("on_time_flights"),
        _rate(delayed, total).alias("delay_rate"),
        (100.0 - _rate(delayed, total)).alias("punctuality_rate"),
        F.coalesce(late, F.lit(0.0)).alias("avg_delay_minutes"),
    )


def _count_by_status(history: DataFrame, column: str) -> DataFrame:
    """Rows by ``column`` and delay status; rows with a null in either are left out."""
    return (
        history.where(F.col(column).isNotNull() & F.col("is_delayed").isNotNull())
        .groupBy(column, "is_delayed")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(column, _status(), "count")
    )


def delays_by_operator(history: DataFrame) -> DataFrame:
    return _count_by_status(history, "operator").orderBy("operator", "status")


def top_routes(history: DataFrame, limit: int = 10) -> DataFrame:
    return (
        history.select(route_label(F.col("origin"), F.col("destination")).alias("route"))
        .where("route IS NOT NULL")
        .groupBy("route")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "route")
        .limit(limit)
    )


def weekday_share(history: DataFrame) -> DataFrame:
    """Count by weekday and status with its share of the weekday (a window over 14 rows)."""
    day_total = F.sum("count").over(W.partitionBy("day_name"))
    return (
        _count_by_status(history, "day_name")
        .withColumn("percentage", 100.0 * F.col("count") / day_total)
        .orderBy(F.array_position(F.lit(DAYS), F.col("day_name")), "status")
    )


def hour_volume(history: DataFrame) -> DataFrame:
    return _count_by_status(history, "hour").orderBy("hour", "status")


def heatmap_cells(history: DataFrame) -> DataFrame:
    total, delayed = F.count("flight_id"), F.count_if("is_delayed")
    return (
        history.where("filed_dep_time IS NOT NULL")  # then hour and day are there too
        .groupBy("hour_group", "day_name")
        .agg(
            total.alias("total_flights"),
            delayed.alias("delayed_flights"),
            F.when(total > 0, 100.0 * delayed / total).alias("delay_pct"),
        )
    )


def heatmap_pivot(cells: DataFrame, value: str = "delay_pct") -> DataFrame:
    """8 × 7 matrix in fixed order; missing cells are 0.

    The fixed day list spares the pivot its discovery pass; the eight bucket rows come from a
    literal union, not a join.
    """
    frame = cells.sparkSession.createDataFrame([(b,) for b in HOUR_BUCKETS], "hour_group string")
    values = cells.select("hour_group", "day_name", F.col(value).cast("double").alias("v"))
    return (
        values.unionByName(frame, allowMissingColumns=True)
        .groupBy("hour_group")
        .pivot("day_name", DAYS)
        .agg(F.first("v", ignorenulls=True))
        .na.fill(0.0, DAYS)
        .orderBy("hour_group")
    )


def fleet_summary(history: DataFrame, min_flights: int = 10) -> DataFrame:
    total, delayed = F.count("flight_id"), F.count_if("is_delayed")
    return (
        history.where("aircraft_type IS NOT NULL")
        .groupBy("aircraft_type")
        .agg(
            total.alias("total_flights"),
            delayed.alias("delayed_flights"),
            F.when(total > 0, 100.0 * delayed / total).alias("delay_percentage"),
        )
        .where(F.col("total_flights") >= min_flights)
        .orderBy(F.desc("delay_percentage"), "aircraft_type")
    )
