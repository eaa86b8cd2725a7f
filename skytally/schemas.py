"""Table contracts."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, TS, INT, LONG, DOUBLE, BOOL = (
    T.StringType(), T.TimestampType(), T.IntegerType(), T.LongType(), T.DoubleType(),
    T.BooleanType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


# Typed view of a flight document.
_STOP = dict(
    airport=STRING, timezone=STRING, iata=STRING, icao=STRING, terminal=STRING, gate=STRING,
    baggage=STRING, delay=INT, scheduled=STRING, estimated=STRING, actual=STRING,
    estimated_runway=STRING, actual_runway=STRING,
)
FLIGHT_DOCUMENT = _struct(
    flight_date=STRING,
    flight_status=STRING,
    flight=_struct(iata=STRING, icao=STRING, number=STRING),
    airline=_struct(name=STRING, iata=STRING, icao=STRING),
    departure=_struct(**_STOP),
    arrival=_struct(**_STOP),
    aircraft=_struct(registration=STRING, iata=STRING, icao=STRING, icao24=STRING),
    live=_struct(
        updated=STRING, latitude=DOUBLE, longitude=DOUBLE, altitude=DOUBLE, direction=DOUBLE,
        speed_horizontal=DOUBLE, speed_vertical=DOUBLE, is_ground=BOOL,
    ),
)

# Bronze: one row per landed payload file, content unchanged.
BRONZE_PAYLOADS = _struct(
    source=STRING, endpoint=STRING, run_id=STRING, file_name=STRING, payload=STRING, loaded_seq=LONG
)

SNAPSHOT_COUNTERS = [
    "observed_flights_total", "observed_flights_active", "observed_flights_scheduled",
    "observed_flights_landed", "observed_flights_cancelled", "observed_flights_diverted",
    "observed_flights_incident", "observed_flights_unknown",
]
SNAPSHOT_DETAILS = [
    "observed_departure_delays_total", "observed_arrival_delays_total",
    "observed_delayed_flights_total", "observed_unique_airlines", "observed_unique_routes",
    "observed_unique_departure_airports", "observed_unique_arrival_airports",
]
SNAPSHOT_INSIGHTS = _struct(
    run_id=STRING, snapshot_at=TS, source=STRING, endpoint=STRING,
    **{name: INT for name in SNAPSHOT_COUNTERS},
    observed_flights_active_pct=T.DecimalType(6, 2),
    **{name: INT for name in SNAPSHOT_DETAILS},
    created_at=TS,
)

ROUTES = _struct(
    run_id=STRING, source=STRING, endpoint=STRING, loaded_at=TS, flight_date=T.DateType(),
    flight_number=STRING, flight_iata=STRING, flight_icao=STRING, flight_status=STRING,
    airline_name=STRING, airline_iata=STRING, airline_icao=STRING,
    aircraft_registration=STRING, aircraft_iata=STRING, aircraft_icao=STRING,
    aircraft_icao24=STRING,
    departure_airport=STRING, departure_iata=STRING, departure_icao=STRING,
    departure_timezone=STRING, departure_region=STRING,
    arrival_airport=STRING, arrival_iata=STRING, arrival_icao=STRING, arrival_timezone=STRING,
    arrival_region=STRING,
    departure_scheduled=TS, departure_estimated=TS, departure_actual=TS,
    arrival_scheduled=TS, arrival_estimated=TS, arrival_actual=TS,
    created_at=TS, loaded_seq=LONG, file_name=STRING, row_ix=LONG,
)
ROUTE_KEY = [
    "run_id", "flight_iata", "departure_iata", "arrival_iata", "aircraft_icao24", "flight_date",
]

# One row per run of the routes table; the run's last row in insertion order.
ROUTE_RUNS = _struct(
    run_id=STRING, created_at=TS, loaded_seq=LONG, file_name=STRING, row_ix=LONG, routes=LONG,
    run_day=STRING,
)
RUN_DAY = "run_day"  # partition of the tables with a row per run, derived from the run's name

PREDICTIONS = _struct(
    flight_iata=STRING, flight_icao=STRING, flight_number=STRING, flight_date=T.DateType(),
    flight_status=STRING, airline_name=STRING, airline_iata=STRING, departure_iata=STRING,
    arrival_iata=STRING,
    departure_scheduled=TS, departure_estimated=TS, departure_actual=TS, departure_delay_min=INT,
    arrival_scheduled=TS, arrival_estimated=TS, arrival_actual=TS, arrival_delay_min=INT,
    live_latitude=DOUBLE, live_longitude=DOUBLE, live_altitude=DOUBLE, live_direction=DOUBLE,
    live_speed_horizontal=DOUBLE, live_speed_vertical=DOUBLE, live_is_ground=BOOL, live_updated=TS,
    model_latitude=DOUBLE, model_longitude=DOUBLE, model_requested_fl=INT,
    model_actual_distance_flown_nm=DOUBLE, model_ac_operator=STRING, model_month=INT,
    model_hour=INT, model_day_of_week=INT,
    predicted_is_delayed=BOOL, delay_probability=T.DecimalType(6, 5), prediction_label=STRING,
    model_name=STRING, model_version=STRING, prediction_created_at=TS,
)
PREDICTION_KEY = [
    "flight_iata", "flight_icao", "flight_number", "flight_date", "departure_scheduled",
]

# Model contract.
TARGET = "is_delayed"
NUMERIC_FEATURES = [
    "Latitude", "Longitude", "Requested FL", "Actual Distance Flown (nm)", "month", "hour",
    "day_of_week",
]
CATEGORICAL_FEATURES = ["AC Operator"]
FEATURES = [
    "Latitude", "Longitude", "Requested FL", "Actual Distance Flown (nm)", "AC Operator", "month",
    "hour", "day_of_week",
]

# Historical flights CSV: text as it lands, typed by the feature plan.
HISTORY_COLUMNS = [
    "ECTRL ID", "ADEP", "ADEP Latitude", "ADEP Longitude", "ADES", "ADES Latitude",
    "ADES Longitude", "FILED OFF BLOCK TIME", "FILED ARRIVAL TIME", "ACTUAL OFF BLOCK TIME",
    "ACTUAL ARRIVAL TIME", "AC Type", "AC Operator", "AC Registration", "ICAO Flight Type",
    "STATFOR Market Segment", "Requested FL", "Actual Distance Flown (nm)",
]
POINTS = T.StructType([
    T.StructField("ECTRL ID", LONG), T.StructField("Sequence Number", INT),
    T.StructField("Latitude", DOUBLE), T.StructField("Longitude", DOUBLE),
])

# Rows and files that a load set aside, with what they held.
QUARANTINE = _struct(
    source=STRING, endpoint=STRING, file_name=STRING, record_ix=INT, reason=STRING, content=STRING,
    set_aside_at=TS, load_id=STRING, load_key=STRING,
)

RUN_LOG = _struct(
    source=STRING, endpoint=STRING, stage=STRING, status=STRING, run_id=STRING, finished_at=TS,
    duration_seconds=DOUBLE, records_processed=LONG,
)
RUN_EVENTS = _struct(timestamp=TS, level=STRING, stage=STRING, event=STRING, details=STRING)
