"""Flight explorer: flat view, status counters, route and status distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions import scalars as S
from skytally.functions.scalars import DELAYED_STATUS_PATTERN, display_value, match_label
from skytally.functions.variants import leaf_columns
from skytally.operators.search import first_existing_column, quoted
from skytally.sources.tables import as_documents

# Column order of the flat view; other columns follow.
PREFERRED_COLUMNS = [
    "flight_date", "flight_status", "flight.iata", "flight.icao", "flight.number",
    "airline.airline_name", "airline.name", "airline.iata_code", "airline.icao_code",
    "airline.country_name", "airline.status", "airline.type", "departure.airport",
    "departure.timezone", "departure.iata", "departure.icao", "departure.terminal",
    "departure.gate", "departure.delay", "departure.scheduled", "departure.estimated",
    "departure.actual", "departure.estimated_runway", "departure.actual_runway",
    "departure.baggage", "arrival.airport", "arrival.timezone", "arrival.iata", "arrival.icao",
    "arrival.terminal", "arrival.gate", "arrival.delay", "arrival.scheduled", "arrival.estimated",
    "arrival.actual", "arrival.estimated_runway", "arrival.actual_runway", "arrival.baggage",
    "aircraft.registration", "aircraft.iata", "aircraft.icao", "aircraft.icao24", "live.updated",
    "live.latitude", "live.longitude", "live.altitude", "live.direction", "live.speed_horizontal",
    "live.speed_vertical", "live.is_ground", "predicted_is_delayed", "delay_probability",
    "prediction_label", "model_name", "model_version", "prediction_created_at", "departure_iata",
    "arrival_iata", "airline_name", "airline_iata", "departure_scheduled", "arrival_scheduled",
    "live_latitude", "live_longitude", "live_altitude", "live_direction", "live_speed_horizontal",
    "live_speed_vertical", "live_is_ground", "live_updated",
]

# Columns tried in turn for each displayed field.
STATUS_COLUMNS = ["flight_status", "status", "flight.status"]
FLIGHT_COLUMNS = [
    "flight.iata", "flight.icao", "flight.number", "flight_iata", "flight_icao", "flight_number",
]
DEPARTURE_COLUMNS = ["departure.iata", "departure_iata", "origin"]
ARRIVAL_COLUMNS = ["arrival.iata", "arrival_iata", "destination"]


def flat_columns(schema: T.StructType, prefix: str = "", source: str = "") -> dict[str, Column]:
    """Dotted name → Column for every leaf of nested structs."""
    leaves: dict[str, Column] = {}
    for field in schema:
        name, path = prefix + field.name, f"{source}`{field.name}`"
        if isinstance(field.dataType, T.StructType):
            leaves.update(flat_columns(field.dataType, f"{name}.", f"{path}."))
        else:
            leaves[name] = F.col(path)
    return leaves


def _ordered(rows: DataFrame, leaves: dict[str, Column]) -> DataFrame:
    order = [c for c in PREFERRED_COLUMNS if c in leaves]
    order += [c for c in leaves if c not in order]
    return rows.select([leaves[c].alias(c) for c in order])


def flat_view(flights: DataFrame) -> DataFrame:
    return _ordered(flights, flat_columns(flights.schema))


def flat_documents(docs: DataFrame, column: str = "doc") -> DataFrame:
    """The flat view of free JSON documents: a column per leaf that any document has.

    Other columns of ``docs`` are left out. Documents that are no objects give a row of nulls, and so
    does a path for documents without it. Lists are JSON text; where a path holds different types, its
    column is text, and the fields of its objects have columns of their own.
    """
    leaves = leaf_columns(docs, column)
    return _ordered(docs, leaves) if leaves else docs.select()


def stored_documents(table: DataFrame) -> DataFrame:
    """The flat view of a document table: key columns and one VARIANT per top-level field."""
    return flat_documents(as_documents(table).select("doc"))


def status_kpis(flat: DataFrame) -> DataFrame:
    """Active, delayed (by wording) and scheduled counts; zeros without a status column."""
    column = first_existing_column(flat, STATUS_COLUMNS)
    status = F.lower(quoted(column).cast("string")) if column else F.lit(None).cast("string")
    return flat.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(status == "active").alias("active"),
        F.count_if(status.rlike(DELAYED_STATUS_PATTERN)).alias("delayed"),
        F.count_if(status == "scheduled").alias("scheduled"),
    )


def top_routes(flat: DataFrame, limit: int = 10) -> DataFrame:
    """Busiest routes; a missing code shows as 'unknown'."""
    ends = [first_existing_column(flat, c) for c in (DEPARTURE_COLUMNS, ARRIVAL_COLUMNS)]
    if None in ends:
        raise ValueError("departure or arrival column not available")
    shown = [F.coalesce(quoted(c).cast("string"), F.lit("unknown")) for c in ends]
    return (
        flat.groupBy(S.route_label(*shown).alias("route"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "route")
        .limit(limit)
    )


def status_distribution(flat: DataFrame) -> DataFrame:
    column = first_existing_column(flat, STATUS_COLUMNS)
    if column is None:
        raise ValueError("status column not available")
    return (
        flat.groupBy(F.coalesce(quoted(column).cast("string"), F.lit("unknown")).alias("status"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "status")
    )


def shown(flat: DataFrame, candidates: list[str], default: str = S.NOT_AVAILABLE) -> Column:
    return display_value([quoted(c) for c in candidates if c in flat.columns], default)


def status_message(flat: DataFrame) -> Column:
    have = lambda *names: [quoted(n) for n in names if n in flat.columns]
    return S.status_message(
        have(*STATUS_COLUMNS),
        have("prediction_label"),
        have("delay_probability"),
        have("departure.delay", "departure_delay", "departure_delay_min"),
        have("arrival.delay", "arrival_delay", "arrival_delay_min"),
    )


def selection_label(flat: DataFrame) -> Column:
    return match_label(
        shown(flat, FLIGHT_COLUMNS),
        shown(flat, DEPARTURE_COLUMNS, "?"),
        shown(flat, ARRIVAL_COLUMNS, "?"),
        shown(flat, STATUS_COLUMNS),
    )
