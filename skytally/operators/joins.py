"""Lookups against small dimensions, and restriction to the latest run."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000


def broadcast_if_small(dimension: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after a bounded count; a larger side stays a shuffled join."""
    small = dimension.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(dimension) if small else dimension


ROWS_PER_TASK = 50_000


def spread_input(df: DataFrame, rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """Spread an input over at least all task slots, and over a task per ``rows_per_task`` rows if given.

    Row-wise work on documents is the costly part, and a split of a Parquet file may hold millions of
    rows, so a round-robin shuffle pays there. An input with enough splits is returned as it is. The rows
    are counted, which for a table reads its footers only.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if rows_per_task:
        wanted = max(wanted, math.ceil(df.count() / rows_per_task))
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters see as values.

    A filter over a plain projection is pushed below it and repeats the projected expression for
    every reference; for chains over a document that multiplies the work. A one-element ``inline``
    is not looked through, so each expression runs once per row.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def lookup_coordinates(
    rows: DataFrame, coordinates: DataFrame, codes: list[str], into: str, fallback: Column | None = None
) -> DataFrame:
    """Add struct ``into`` (latitude, longitude): the first of ``codes`` found, else ``fallback``.

    ``coordinates`` has unique codes, so the left joins neither drop nor repeat rows.
    """
    found = []
    for ix, code in enumerate(codes):
        side = coordinates.select(
            F.col("code").alias(f"_code{ix}"), F.struct("latitude", "longitude").alias(f"_at{ix}")
        )
        rows = rows.join(side, F.col(code) == F.col(f"_code{ix}"), "left")
        found.append(F.col(f"_at{ix}"))
    if fallback is not None:
        found.append(fallback)
    drop = [n for ix in range(len(codes)) for n in (f"_code{ix}", f"_at{ix}")]
    return rows.withColumn(into, F.coalesce(*found)).drop(*drop)


def coordinate_pair(latitude: Column, longitude: Column) -> Column:
    """A (latitude, longitude) struct, null unless both are there."""
    return F.when(
        latitude.isNotNull() & longitude.isNotNull(),
        F.struct(latitude.alias("latitude"), longitude.alias("longitude")),
    )


def on_followed_routes(
    flights: DataFrame, routes: list[tuple[str, str]], departure: str, arrival: str, status: str
) -> DataFrame:
    """Scheduled flights on the listed routes (left semi-join)."""
    listed = flights.sparkSession.createDataFrame(routes, "_dep string, _arr string")
    return flights.where(F.col(status) == "scheduled").join(
        F.broadcast(listed) if len(routes) <= MAX_BROADCAST_ROWS else listed,
        (F.col(departure) == F.col("_dep")) & (F.col(arrival) == F.col("_arr")),
        "left_semi",
    )


def at_latest_run(rows: DataFrame, ordinal: Column | str, run_id: str = "run_id") -> DataFrame:
    """Rows of the run with the highest ordinal: a scalar subquery, so ``run_id`` still prunes."""
    latest = rows.agg(F.max_by(run_id, ordinal).alias("latest"))
    return rows.where(F.col(run_id) == latest.scalar())


def origin_points(points: DataFrame) -> DataFrame:
    return points.where(F.col("Sequence Number") == 0).select(
        F.col("ECTRL ID").alias("points_id"), "Latitude", "Longitude"
    )


def with_origin_point(flights: DataFrame, points: DataFrame) -> DataFrame:
    """Inner join of flights and their first trajectory point; AQE splits a skewed id."""
    origin = origin_points(points)
    clashing = [c for c in ("Latitude", "Longitude") if c in flights.columns]
    return (
        flights.drop(*clashing)
        .join(origin, F.col("ECTRL ID") == F.col("points_id"), "inner")
        .drop("points_id")
    )
