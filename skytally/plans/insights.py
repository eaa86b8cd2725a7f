"""Per-snapshot traffic indicators, flight routes, and the dashboard queries over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions import records as R
from skytally.functions.scalars import (
    first_text, parse_day, parse_timestamp, percentage, route_label, timezone_region,
)
from skytally.operators.joins import at_latest_run
from skytally.schemas import ROUTE_RUNS, ROUTES, RUN_DAY, SNAPSHOT_INSIGHTS
from skytally.sources.tables import conform

STATUSES = ["active", "scheduled", "landed", "cancelled", "diverted", "incident", "unknown"]


def snapshot_insights(records: DataFrame, keys: tuple[str, ...] = ("run_id", "source", "endpoint")) -> DataFrame:
    """One row of indicators per snapshot from VARIANT records in ``doc``.

    A null ``doc`` stands for a payload without records: it makes the row but counts nowhere.

    Two steps: first by snapshot and code triple, which combines on the map side and spreads one
    large run over many reducers; then the distinct counts over those few groups.
    """
    doc = F.col("doc")
    facts = records.select(
        *keys,
        F.when(doc.isNotNull(), first_text(
            R.text_at(doc, "flight.flight_status"), R.text_at(doc, "flight_status"), F.lit("unknown")
        )).alias("status"),
        F.nullif(R.text_at(doc, "airline.iata"), F.lit("")).alias("airline"),
        F.nullif(R.text_at(doc, "departure.iata"), F.lit("")).alias("dep"),
        F.nullif(R.text_at(doc, "arrival.iata"), F.lit("")).alias("arr"),
        R.is_positive_number(R.at(doc, "departure.delay")).alias("dep_late"),
        R.is_positive_number(R.at(doc, "arrival.delay")).alias("arr_late"),
    )
    status_counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    by_code = facts.groupBy(*keys, "airline", "dep", "arr").agg(
        F.count("status").alias("total"),
        *status_counts,
        F.count_if("dep_late").alias("dep_late"),
        F.count_if("arr_late").alias("arr_late"),
        F.count_if(F.col("dep_late") | F.col("arr_late")).alias("late"),
    )
    whole = lambda c, name: F.sum(c).cast("int").alias(name)
    distinct = lambda c, name: F.count_distinct(c).cast("int").alias(name)
    return by_code.groupBy(*keys).agg(
        whole("total", "observed_flights_total"),
        *[whole(s, f"observed_flights_{s}") for s in STATUSES],
        percentage(F.sum("active"), F.sum("total")).alias("observed_flights_active_pct"),
        whole("dep_late", "observed_departure_delays_total"),
        whole("arr_late", "observed_arrival_delays_total"),
        whole("late", "observed_delayed_flights_total"),
        distinct(F.col("airline"), "observed_unique_airlines"),
        distinct(F.concat("dep", F.lit("-"), "arr"), "observed_unique_routes"),
        distinct(F.col("dep"), "observed_unique_departure_airports"),
        distinct(F.col("arr"), "observed_unique_arrival_airports"),
    )


def stamp_insights(rows: DataFrame, snapshot_at: Column) -> DataFrame:
    return conform(
        rows.withColumn("snapshot_at", snapshot_at).withColumn("created_at", snapshot_at),
        SNAPSHOT_INSIGHTS,
    )


def last_file_per_run(rows: DataFrame) -> DataFrame:
    """Of several files of one run, the last by name counts."""
    values = [c for c in rows.columns if c not in ("run_id", "file_name")]
    return (
        rows.groupBy("run_id")
        .agg(F.max_by(F.struct(*values), "file_name").alias("_r"))
        .select("run_id", "_r.*")
    )


def flatten_routes(records: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """One route row per record; run_id, source, endpoint, row_ix and loaded_seq are carried over."""
    doc = F.col("doc")
    text = lambda path: R.text_at(doc, path)
    either = lambda *paths: R.first_text_at(doc, *paths)
    stamps = {
        f"{stop}_{kind}": parse_timestamp(text(f"{stop}.{kind}"))
        for stop in ("departure", "arrival")
        for kind in ("scheduled", "estimated", "actual")
    }
    rows = records.withColumns({
        "loaded_at": loaded_at if loaded_at is not None else parse_timestamp(text("_meta.loaded_at")),
        "flight_date": parse_day(text("flight_date")),
        "flight_number": either("flight_number", "flight.number"),
        "flight_iata": either("flight.iata", "flight_number"),
        "flight_icao": text("flight.icao"),
        "flight_status": either("flight_status", "flight.flight_status"),
        "airline_name": text("airline.name"),
        "airline_iata": either("airline.iata", "airline_iata"),
        "airline_icao": text("airline.icao"),
        **{f"aircraft_{k}": text(f"aircraft.{k}") for k in ("registration", "iata", "icao", "icao24")},
        "departure_airport": text("departure.airport"),
        "departure_iata": either("departure.iata", "departure_iata"),
        "departure_icao": text("departure.icao"),
        "departure_timezone": text("departure.timezone"),
        "departure_region": timezone_region(text("departure.timezone")),
        "arrival_airport": text("arrival.airport"),
        "arrival_iata": either("arrival.iata", "arrival_iata"),
        "arrival_icao": text("arrival.icao"),
        "arrival_timezone": text("arrival.timezone"),
        "arrival_region": timezone_region(text("arrival.timezone")),
        **stamps,
        "created_at": F.current_timestamp(),
        "row_ix": F.col("record_ix").cast("bigint"),
    })
    return conform(rows, ROUTES)


def insertion_order() -> Column:
    """Order in which stored routes were first written; an upsert keeps ``created_at``."""
    return F.struct("created_at", "loaded_seq", "file_name", "row_ix")


def run_day(run_id: Column) -> Column:
    """The day a run's name tells, ``other`` where it tells none."""
    day = F.regexp_extract(F.coalesce(run_id, F.lit("")), r"(\d{4})-?(\d{2})-?(\d{2})", 0)
    return F.when(day == "", "other").otherwise(F.regexp_replace(day, "-", ""))


def route_runs(routes: DataFrame) -> DataFrame:
    """The run index: a row per run with its last row's place in insertion order."""
    rows = routes.groupBy("run_id").agg(F.max(insertion_order()).alias("last"), F.count(F.lit(1)).alias("routes"))
    return conform(rows.select("run_id", "last.*", "routes", run_day(F.col("run_id")).alias(RUN_DAY)), ROUTE_RUNS)


def of_latest_run(
    routes: DataFrame, ordinal: Column | str | None = None, runs: DataFrame | None = None
) -> DataFrame:
    """Routes of the run that was written to last.

    With the run index only that run's partition is read; without it all routes are, for the highest
    ``ordinal``.
    """
    if runs is None:
        return at_latest_run(routes, insertion_order() if ordinal is None else ordinal)
    latest = runs.agg(F.max_by("run_id", insertion_order()).alias("latest"))
    return routes.where(F.col("run_id") == latest.scalar())


def latest_route_count(
    routes: DataFrame, ordinal: Column | str | None = None, runs: DataFrame | None = None
) -> DataFrame:
    return of_latest_run(routes, ordinal, runs).agg(F.count(F.lit(1)).alias("total_routes"))


def region_flows(
    routes: DataFrame, ordinal: Column | str | None = None, limit: int = 20, runs: DataFrame | None = None
) -> DataFrame:
    """Region pairs of the latest run; ``concat`` is null when a region is."""
    flow = route_label(F.col("departure_region"), F.col("arrival_region"))
    return (
        of_latest_run(routes, ordinal, runs)
        .where(F.col("departure_region").isNotNull() & F.col("arrival_region").isNotNull())
        .groupBy(flow.alias("route_region"))
        .agg(F.count(F.lit(1)).alias("flights"))
        .orderBy(F.desc("flights"), "route_region")
        .limit(limit)
    )


LATEST_ROUTE_COLUMNS = [
    "flight_date", "run_id", "aircraft_icao24", "airline_iata", "flight_iata", "departure_iata",
    "departure_region", "arrival_iata", "arrival_region", "flight_status",
]


def latest_routes(
    routes: DataFrame, ordinal: Column | str | None = None, limit: int = 100, ties: tuple[str, ...] = (),
    runs: DataFrame | None = None,
) -> DataFrame:
    """Routes of the latest run by departure; nulls last as the dashboards expect."""
    return (
        of_latest_run(routes, ordinal, runs)
        .orderBy(F.asc_nulls_last("departure_scheduled"), F.asc_nulls_last("flight_iata"), *ties)
        .limit(limit)
        .select(
            F.col("flight_date").cast("string").alias("flight_date"),
            *[c for c in LATEST_ROUTE_COLUMNS[1:]],
        )
    )


def latest_snapshot(insights: DataFrame) -> DataFrame:
    return (
        insights.orderBy(F.desc_nulls_last("snapshot_at"), F.desc("run_id")).limit(1).select(
            F.col("snapshot_at").alias("time"), "observed_flights_total",
            "observed_flights_active", "observed_delayed_flights_total",
        )
    )


def extractor_metrics(raw: DataFrame, extracted: DataFrame, page: str = "file_name") -> DataFrame:
    """Raw records, extracted records and pages, as one row."""
    counted = raw.select(F.lit(1).alias("r"), F.lit(0).alias("x"), F.col(page).alias("p")).unionByName(
        extracted.select(F.lit(0).alias("r"), F.lit(1).alias("x"), F.lit(None).cast("string").alias("p"))
    )
    by_page = counted.groupBy("p").agg(F.sum("r").alias("r"), F.sum("x").alias("x"))
    return by_page.agg(
        F.coalesce(F.sum("r"), F.lit(0)).alias("raw_count"),
        F.coalesce(F.sum("x"), F.lit(0)).alias("extracted_count"),
        F.count("p").alias("pages_fetched"),
    )


def in_air_domestic(records: DataFrame) -> DataFrame:
    """In-air flights between followed airports, pruned."""
    doc = F.col("doc")
    kept = records.where(
        R.is_followed_airport_pair(R.text_at(doc, "departure.iata"), R.text_at(doc, "arrival.iata"))
        & R.is_in_air(doc)
    )
    return R.prune_documents(kept.withColumn("doc", F.to_json("doc")), "doc")
