"""Model features from the flight history and from live documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions import records as R
from skytally.functions import scalars as S
from skytally.operators.joins import (
    broadcast_if_small, coordinate_pair, lookup_coordinates, with_computed, with_origin_point,
)
from skytally.operators.search import require_columns
from skytally.plans.serving import departure_time
from skytally.schemas import FEATURES, TARGET

HISTORY_REQUIRED = [
    "ADEP", "ADES", "ADEP Latitude", "ADEP Longitude", "ADES Latitude", "ADES Longitude",
    "FILED OFF BLOCK TIME", "ACTUAL OFF BLOCK TIME", "Requested FL", "AC Operator",
]
RECORDED_DISTANCE = "Actual Distance Flown (nm)"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def only_features(df: DataFrame) -> DataFrame:
    """Target and features of the rows that have them all."""
    return df.select([_q(c) for c in [TARGET, *FEATURES]]).dropna()


def complete_features(df: DataFrame) -> DataFrame:
    return df.dropna(subset=FEATURES)


def route_distance() -> Column:
    return S.haversine_nm(*[
        S.to_number(_q(c))
        for c in ("ADEP Latitude", "ADEP Longitude", "ADES Latitude", "ADES Longitude")
    ])


def is_french_domestic() -> Column:
    ends = [F.upper(F.trim(c)).startswith(R.FRENCH_ICAO_PREFIX) for c in ("ADEP", "ADES")]
    return ends[0] & ends[1]


def french_domestic_history(history: DataFrame) -> DataFrame:
    return history.where(is_french_domestic())


def history_features(
    history: DataFrame, keep_only: bool = False, use_route_distance: bool = True
) -> DataFrame:
    """Delay target, calendar, coordinates and distance; one narrow stage over the scan.

    An unknown delay counts as on time in the target. ``keep_only`` leaves target and features of
    complete rows; otherwise all original columns stay.
    """
    required = HISTORY_REQUIRED + ([] if use_route_distance else [RECORDED_DISTANCE])
    require_columns(history, required)
    filed, actual = F.col("filed_dep"), F.col("actual_dep")
    distance = route_distance() if use_route_distance else S.to_number(_q(RECORDED_DISTANCE))
    read = {
        "filed_dep": S.parse_history_timestamp(_q("FILED OFF BLOCK TIME")),
        "actual_dep": S.parse_history_timestamp(_q("ACTUAL OFF BLOCK TIME")),
        "Latitude": S.to_number(_q("ADEP Latitude")),
        "Longitude": S.to_number(_q("ADEP Longitude")),
        "_distance": distance,
        "_level": S.to_number(_q("Requested FL")),
        "_operator": S.clean_text(_q("AC Operator"), upper=True),
    }
    kept = french_domestic_history(history.drop("Latitude", "Longitude"))
    rows = (
        with_computed(kept, read)
        .withColumns({
            "departure_delay_min": S.minutes_between(filed, actual),
            **S.calendar_features(filed),
            RECORDED_DISTANCE: F.col("_distance"),
            "Requested FL": F.col("_level"),
            "AC Operator": F.col("_operator"),
        })
        .withColumn(TARGET, S.delayed_flag(F.col("departure_delay_min")))
        .drop("_distance", "_level", "_operator")
    )
    return only_features(rows) if keep_only else rows


def trajectory_features(history: DataFrame, points: DataFrame) -> DataFrame:
    """Notebook variant: coordinates of the first trajectory point, recorded distance, no country
    filter."""
    filed = F.to_timestamp("FILED OFF BLOCK TIME", "dd-MM-yyyy HH:mm:ss")
    actual = F.to_timestamp("ACTUAL OFF BLOCK TIME", "dd-MM-yyyy HH:mm:ss")
    timed = with_computed(history, {"filed_dep": filed, "actual_dep": actual}).withColumns({
        "departure_delay_min": S.minutes_between(F.col("filed_dep"), F.col("actual_dep")),
        **S.calendar_features(F.col("filed_dep")),
    }).withColumn(TARGET, S.delayed_flag(F.col("departure_delay_min")))
    return only_features(with_origin_point(timed, points))


def requested_level(doc: Column, default: int = S.DEFAULT_REQUESTED_FL) -> Column:
    value = R.first_truthy_at(
        doc, "flight.requested_fl", "flight.requested_flight_level", "flight.flight_level",
        "requested_fl", "requested_flight_level", "flight_level", "eurocontrol.requested_fl",
    )
    return F.coalesce(R.whole_of(value), F.lit(default))


def enriched_distance(doc: Column) -> Column:
    value = R.first_truthy_at(
        doc, "flight.actual_distance_flown_nm", "flight.route_distance_nm",
        "actual_distance_flown_nm", "route_distance_nm", "distance_nm",
        "eurocontrol.actual_distance_flown_nm", "eurocontrol.route_distance_nm",
    )
    return R.number_of(value)


def payload_arrival(doc: Column) -> Column:
    """Arrival coordinates carried by the record itself; both must parse."""
    latitude = R.first_truthy_at(
        doc, "arrival.latitude", "arrival.lat", "arrival_latitude", "arrival_lat")
    longitude = R.first_truthy_at(
        doc, "arrival.longitude", "arrival.lon", "arrival_longitude", "arrival_lon")
    return coordinate_pair(R.number_of(latitude), R.number_of(longitude))


def live_features(
    flights: DataFrame,
    coordinates: DataFrame,
    use_enriched_distance: bool = False,
    default_level: int = S.DEFAULT_REQUESTED_FL,
) -> DataFrame:
    """The eight model features for French domestic documents, all input columns carried along.

    Only complete rows remain. What the document itself gives is read before the lookups, so the
    joins carry plain columns and no expression is expanded into another. The coordinate table is
    looked up four times (departure and arrival, IATA then ICAO); below the checked size these are
    broadcast joins in one stage without a shuffle.
    """
    doc = F.col("doc")
    codes = {
        "_dep_iata": R.departure_iata(doc), "_arr_iata": R.arrival_iata(doc),
        "_dep_icao": R.departure_icao(doc), "_arr_icao": R.arrival_icao(doc),
    }
    read = {
        "_departs": departure_time(doc),
        "_arrival": payload_arrival(doc),
        "AC Operator": R.operator_code(doc),
        "Requested FL": requested_level(doc, default_level),
    }
    if use_enriched_distance:
        read["_enriched"] = enriched_distance(doc)
    rows = with_computed(flights, codes).where(R.is_french_domestic(*[F.col(c) for c in codes]))
    rows = with_computed(rows, read)
    places = broadcast_if_small(coordinates)
    rows = lookup_coordinates(rows, places, ["_dep_iata", "_dep_icao"], "_origin")
    rows = lookup_coordinates(
        rows, places, ["_arr_iata", "_arr_icao"], "_target", fallback=F.col("_arrival")
    )
    distance = S.haversine_nm(*[
        F.col(c) for c in
        ("_origin.latitude", "_origin.longitude", "_target.latitude", "_target.longitude")
    ])
    has_distance = F.col("_target").isNotNull()
    if use_enriched_distance:
        distance = F.coalesce("_enriched", distance)
        has_distance = has_distance | F.col("_enriched").isNotNull()
    complete = rows.where(
        F.col("_origin").isNotNull() & has_distance
        & F.col("_departs").isNotNull() & _q("AC Operator").isNotNull()
    )
    return complete.withColumns({
        "Latitude": F.col("_origin.latitude"),
        "Longitude": F.col("_origin.longitude"),
        RECORDED_DISTANCE: distance,
        **S.calendar_features(F.col("_departs")),
    }).drop(*codes, "_origin", "_target", "_departs", "_arrival", "_enriched")
