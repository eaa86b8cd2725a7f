"""Serving queries over the predictions table, the documents and the history table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions import records as R
from skytally.functions import scalars as S
from skytally.operators.search import check_limit, documents_matching, like_any_id
from skytally.operators.trigrams import TrigramIndex
from skytally.schemas import PREDICTIONS
from skytally.sources.tables import conform


def _newest_first(ties: tuple[str, ...]) -> list[Column]:
    return [F.desc_nulls_last(c) for c in ("prediction_created_at", "departure_scheduled")] + [
        F.col(t) for t in ties
    ]


def business_kpis(predictions: DataFrame) -> DataFrame:
    status = F.lower(F.coalesce("flight_status", F.lit("")))
    n = F.count(F.lit(1))
    return predictions.agg(
        n.alias("observed_flights"),
        F.count_if(status == "active").alias("active_flights"),
        F.count_if(status == "landed").alias("landed_flights"),
        F.count_if("predicted_is_delayed").alias("predicted_delayed_flights"),
        n.alias("route_records"),
    )


def status_summary(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy(F.coalesce("flight_status", F.lit("unknown")).alias("flight_status"))
        .agg(F.count(F.lit(1)).alias("flights"))
        .orderBy(F.desc("flights"), "flight_status")
    )


def top_routes(predictions: DataFrame, limit: int = 10) -> DataFrame:
    check_limit(limit, 1, 100)
    return (
        predictions.groupBy(
            F.coalesce("departure_iata", F.lit("unknown")).alias("departure_iata"),
            F.coalesce("arrival_iata", F.lit("unknown")).alias("arrival_iata"),
        )
        .agg(
            F.count(F.lit(1)).alias("flights"),
            F.count_if("predicted_is_delayed").alias("predicted_delayed_flights"),
            F.avg("delay_probability").cast("double").alias("avg_delay_probability"),
        )
        .orderBy(F.desc("flights"), "departure_iata", "arrival_iata")
        .limit(limit)
    )


def latest_flights(predictions: DataFrame, limit: int = 20, ties: tuple[str, ...] = ()) -> DataFrame:
    check_limit(limit, 1, 200)
    return predictions.orderBy(*_newest_first(ties)).limit(limit)


def search_flights(
    predictions: DataFrame, text: str, limit: int = 10, ties: tuple[str, ...] = (), index: TrigramIndex | None = None
) -> DataFrame:
    check_limit(limit, 1, 50)
    hits = index.like_any_id(predictions, text) if index else like_any_id(predictions, text)
    return hits.orderBy(*_newest_first(ties)).limit(limit)


def search_documents(docs: DataFrame, pattern: str, limit: int = 10, order: tuple[str, ...] = ()) -> DataFrame:
    check_limit(limit, 1, 50)
    hits = documents_matching(docs, pattern)
    return (hits.orderBy(*order) if order else hits).limit(limit)


def historical_analytics(history: DataFrame, operator: str | None = None, limit: int = 0) -> DataFrame:
    """French domestic history with text columns typed; ``LF`` is matched as it is written."""
    minutes = S.text_number(F.col("departure_delay_min"))
    filed = F.col("`FILED OFF BLOCK TIME`")
    rows = history.where(
        (filed != "") & F.col("ADEP").startswith("LF") & F.col("ADES").startswith("LF")
    )
    if operator:
        rows = rows.where(F.col("`AC Operator`") == operator)
    rows = rows.select(
        F.col("`ECTRL ID`").alias("flight_id"),
        F.col("`AC Operator`").alias("operator"),
        F.col("`AC Type`").alias("aircraft_type"),
        F.col("ADEP").alias("origin"),
        F.col("ADES").alias("destination"),
        filed.alias("filed_dep_time"),
        F.col("`ACTUAL OFF BLOCK TIME`").alias("actual_dep_time"),
        S.text_number(F.col("`Actual Distance Flown (nm)`")).alias("distance_nm"),
        minutes.alias("delay_minutes"),
        S.delayed_or_null(minutes).alias("is_delayed"),
    )
    return rows.limit(limit) if limit > 0 else rows


def live_info(doc: Column) -> dict[str, Column]:
    numbers = (
        "latitude", "longitude", "altitude", "direction", "speed_horizontal", "speed_vertical",
    )
    return {
        **{f"live_{n}": R.number_at(doc, f"live.{n}") for n in numbers},
        "live_is_ground": F.try_variant_get(doc, F.lit("$.live.is_ground"), "boolean"),
        "live_updated": S.parse_timestamp(R.text_at(doc, "live.updated")),
    }


def operational_info(doc: Column) -> dict[str, Column]:
    return {
        "flight_iata": R.clean_text_at(doc, ["flight.iata", "flight_iata"], upper=True),
        "flight_icao": R.clean_text_at(doc, ["flight.icao", "flight_icao"], upper=True),
        "departure_iata": R.departure_iata(doc),
        "departure_icao": R.departure_icao(doc),
        "arrival_iata": R.arrival_iata(doc),
        "arrival_icao": R.arrival_icao(doc),
        "airline_operator": R.operator_code(doc),
        "departure_scheduled": departure_time(doc),
    }


def departure_time(doc: Column) -> Column:
    """Scheduled, else estimated, else actual departure."""
    return S.parse_timestamp(R.first_text_at(
        doc, "departure.scheduled", "departure_scheduled", "departure.estimated",
        "departure_estimated", "departure.actual", "departure_actual",
    ))


def serving_records(scored: DataFrame, model_name: str, model_version: str, created_at: Column) -> DataFrame:
    """Prediction rows from scored documents (``doc``, feature columns, prediction columns)."""
    doc = F.col("doc")
    clean = lambda *paths: R.clean_text_at(doc, paths)
    stamps = {
        f"{stop}_{kind}": S.parse_timestamp(R.first_text_at(doc, f"{stop}.{kind}", f"{stop}_{kind}"))
        for stop in ("departure", "arrival")
        for kind in ("scheduled", "estimated", "actual")
    }
    delays = {
        f"{stop}_delay_min": R.whole_of(R.first_truthy_at(doc, f"{stop}.delay", f"{stop}_delay_min"))
        for stop in ("departure", "arrival")
    }
    delayed, chance = F.col("predicted_is_delayed"), F.col("delay_probability")
    rows = scored.select(
        clean("flight.iata", "flight_iata", "flight_number").alias("flight_iata"),
        clean("flight.icao", "flight_icao").alias("flight_icao"),
        clean("flight.number", "flight_number").alias("flight_number"),
        S.parse_day(R.text_at(doc, "flight_date")).alias("flight_date"),
        clean("flight_status").alias("flight_status"),
        clean("airline.airline_name", "airline.name").alias("airline_name"),
        R.airline_iata(doc).alias("airline_iata"),
        R.departure_iata(doc).alias("departure_iata"),
        R.arrival_iata(doc).alias("arrival_iata"),
        *[c.alias(n) for n, c in {**stamps, **delays, **live_info(doc)}.items()],
        F.col("Latitude").alias("model_latitude"),
        F.col("Longitude").alias("model_longitude"),
        F.col("`Requested FL`").alias("model_requested_fl"),
        F.col("`Actual Distance Flown (nm)`").alias("model_actual_distance_flown_nm"),
        F.col("`AC Operator`").alias("model_ac_operator"),
        F.col("month").alias("model_month"),
        F.col("hour").alias("model_hour"),
        F.col("day_of_week").alias("model_day_of_week"),
        delayed.alias("predicted_is_delayed"),
        chance.alias("delay_probability"),
        S.risk_label(delayed, chance).alias("prediction_label"),
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        created_at.alias("prediction_created_at"),
    )
    return conform(rows, PREDICTIONS)
