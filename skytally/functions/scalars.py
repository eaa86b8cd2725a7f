"""Scalar rules as Column expressions. Nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_NM = 3440.065
DELAY_THRESHOLD_MINUTES = 15
DEFAULT_REQUESTED_FL = 350
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
HIGH_RISK, MEDIUM_RISK = 0.70, 0.40
DELAYED_STATUS_PATTERN = "delay|delayed|late|demorado|atrasado"
NOT_AVAILABLE = "Not available"

HOUR_BUCKETS = [f"{start:02d}h-{start + 2:02d}h" for start in range(0, 24, 3)]


# --- emptiness -------------------------------------------------------------------------------


def once(value: Column, rule: Callable[[Column], Column]) -> Column:
    """``rule`` of a value that is computed once, however often the rule names it.

    A costly expression named twice in a condition is evaluated twice, and rules over rules multiply that.
    """
    return F.element_at(F.transform(F.array(value), rule), 1)


def first_text(*columns: Column) -> Column:
    """First non-empty text; the last operand is returned as it is, even when empty."""
    *heads, last = columns
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in heads], last)


def first_number(*columns: Column) -> Column:
    """Numeric form of :func:`first_text`: zero counts as missing except in the last place."""
    *heads, last = columns
    return F.coalesce(*[F.nullif(c, F.lit(0).cast("double")) for c in heads], last)


def clean_text(column: Column, upper: bool = False) -> Column:
    trimmed = F.nullif(F.trim(column), F.lit(""))
    return F.upper(trimmed) if upper else trimmed


def normal_label(column: Column) -> Column:
    return F.lower(F.trim(column))


def null_if_nan(column: Column) -> Column:
    return F.nanvl(column, F.lit(None).cast("double"))


def display_value(columns: Sequence[Column], default: str = NOT_AVAILABLE) -> Column:
    """First value that is neither null nor blank, as text."""
    texts = [F.when(F.trim(c.cast("string")) != "", c.cast("string")) for c in columns]
    return F.coalesce(*texts, F.lit(default))


# --- numbers ---------------------------------------------------------------------------------


def to_number(column: Column) -> Column:
    """Text to double, null when it is not a plain decimal number.

    Java's parser also takes ``1d``, ``0x1p3``, ``NaN`` and ``Infinity``; the character test keeps
    those out.
    """
    text = column.cast("string")
    return F.when(~text.rlike("[dDfFxXnN]"), text.try_cast("double"))


def to_whole(column: Column) -> Column:
    return to_number(column).try_cast("int")


def text_number(column: Column) -> Column:
    """``CAST(NULLIF(x, '') AS FLOAT)`` over a text column."""
    return to_number(F.nullif(column, F.lit("")))


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage, 0 for an empty whole."""
    return F.coalesce(F.round(100 * part / F.nullif(whole, F.lit(0)), digits), F.lit(0.0))


# --- dates -----------------------------------------------------------------------------------


def parse_timestamp(column: Column) -> Column:
    """ISO text is year-month-day; ``dd-MM-yyyy`` and ``dd/MM/yyyy`` are day-first."""
    def parsed(text: Column) -> Column:
        iso = F.when(text.rlike(r"^\d{4}-\d{2}"), text.try_cast("timestamp"))
        day_first = F.when(
            text.rlike(r"^\d{1,2}[-/]"),
            F.try_to_timestamp(F.translate(text, "/", "-"), F.lit("d-M-yyyy[ H:mm[:ss]]")),
        )
        return F.coalesce(iso, day_first)

    return once(F.trim(column.cast("string")), parsed)


def parse_day(column: Column) -> Column:
    return F.to_date(parse_timestamp(column))


def parse_history_timestamp(column: Column) -> Column:
    """``dd-MM-yyyy HH:mm:ss`` first, then the general rule row by row."""
    exact = F.try_to_timestamp(column, F.lit("dd-MM-yyyy HH:mm:ss"))
    return F.coalesce(exact, parse_timestamp(column))


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000.0)


def calendar_features(ts: Column) -> dict[str, Column]:
    """Month, hour and the 1 = Sunday day of week."""
    return {"month": F.month(ts), "hour": F.hour(ts), "day_of_week": F.dayofweek(ts)}


def hour_bucket(hour: Column) -> Column:
    """Label of the 3-hour bucket, taken from the fixed list (no formatting per row)."""
    return F.try_element_at(F.lit(HOUR_BUCKETS), F.floor(hour / 3).cast("int") + 1)


def day_name(ts: Column) -> Column:
    return F.try_element_at(F.lit(DAYS), F.weekday(ts) + 1)


def monday_based_weekday(ts: Column) -> Column:
    return F.weekday(ts)


# --- delay labels ----------------------------------------------------------------------------


def delayed_or_null(minutes: Column) -> Column:
    """Unknown delay stays unknown (history queries)."""
    return minutes > DELAY_THRESHOLD_MINUTES


def delayed_flag(minutes: Column) -> Column:
    """Unknown delay counts as on time (model target)."""
    return F.coalesce(delayed_or_null(minutes).cast("int"), F.lit(0))


# Texts of the status messages and labels.
DELAYED, ON_TIME = "Delayed", "On time"
HIGH_TEXT, MEDIUM_TEXT, LOW_TEXT = "High risk of delay", "Medium risk of delay", "Low risk of delay"
REPORTED_TEXT, REPORTED_END = "The flight is currently reported as '", "'. "
PREDICTED_TEXT, CHANCE_START, CHANCE_END = "The ML model predicts: ", " with ", "% delay probability."
LOOKS_DELAYED_TEXT = "The flight appears to be delayed according to its reported status."
DEPARTURE_TEXT = "The flight has delay information reported. Departure delay: "
ARRIVAL_TEXT, MINUTES_END = " min. Arrival delay: ", " min."
STATUS_TEXT, STATUS_END = "The flight status is currently reported as '", "'."
UNCLEAR_TEXT = "The flight status could not be fully interpreted from the available fields."


def risk_label(delayed: Column, probability: Column) -> Column:
    return (
        F.when(probability.isNull(), F.when(delayed, DELAYED).otherwise(ON_TIME))
        .when(probability >= HIGH_RISK, HIGH_TEXT)
        .when(probability >= MEDIUM_RISK, MEDIUM_TEXT)
        .otherwise(LOW_TEXT)
    )


def status_message(
    status: Sequence[Column],
    label: Sequence[Column],
    probability: Sequence[Column],
    departure_delay: Sequence[Column],
    arrival_delay: Sequence[Column],
) -> Column:
    """Readable status: prediction text first, then reported delay, then the plain status."""
    shown = display_value(status)
    predicted = display_value(label, "")
    chance = to_number(display_value(probability, ""))
    dep_number = to_number(display_value(departure_delay, "0"))
    arr_number = to_number(display_value(arrival_delay, "0"))
    both_numeric = dep_number.isNotNull() & arr_number.isNotNull()
    dep = F.when(both_numeric, dep_number.try_cast("int")).otherwise(0)
    arr = F.when(both_numeric, arr_number.try_cast("int")).otherwise(0)
    lowered = F.lower(shown)
    reported = F.concat(F.lit(REPORTED_TEXT), shown, F.lit(REPORTED_END))
    model = F.concat(reported, F.lit(PREDICTED_TEXT), predicted)
    return (
        F.when(
            ~predicted.isin("", NOT_AVAILABLE) & chance.isNotNull(),
            F.concat(model, F.lit(CHANCE_START), F.format_string("%.1f", chance * 100),
                     F.lit(CHANCE_END)),
        )
        .when(~predicted.isin("", NOT_AVAILABLE), F.concat(model, F.lit(".")))
        .when(
            lowered.contains("delay") | lowered.contains("late"),
            F.lit(LOOKS_DELAYED_TEXT),
        )
        .when(
            (dep > 0) | (arr > 0),
            F.concat(
                F.lit(DEPARTURE_TEXT),
                dep.cast("string"), F.lit(ARRIVAL_TEXT), arr.cast("string"),
                F.lit(MINUTES_END),
            ),
        )
        .when(
            lowered.isin("active", "scheduled", "landed"),
            F.concat(F.lit(STATUS_TEXT), shown, F.lit(STATUS_END)),
        )
        .otherwise(
            F.lit(UNCLEAR_TEXT)
        )
    )


# --- geography and labels --------------------------------------------------------------------


def haversine_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in nautical miles; null when a coordinate is null."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    )
    return 2 * EARTH_RADIUS_NM * F.asin(F.sqrt(chord))


def timezone_region(column: Column) -> Column:
    return F.substring_index(F.nullif(column, F.lit("")), "/", 1)


def route_label(origin: Column, destination: Column) -> Column:
    """``origin → destination``; null when either end is null."""
    return F.concat(origin, F.lit(" → "), destination)


def match_label(flight: Column, origin: Column, destination: Column, status: Column) -> Column:
    return F.concat(flight, F.lit(" | "), route_label(origin, destination), F.lit(" | "), status)


def new_run_id(now: datetime | None = None) -> str:
    stamp = (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")
    return f"{stamp}_{uuid4().hex[:8]}"
