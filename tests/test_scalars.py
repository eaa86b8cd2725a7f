import math
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skytally.functions import scalars as S


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize("text, expected", [
    ("12", 12.0), (" 1.5 ", 1.5), ("-2e3", -2000.0), ("", None), ("null", None), ("nan", None),
    ("inf", None), ("1d", None), ("0x1p3", None), ("abc", None), (None, None),
])
def test_to_number(spark, text, expected):
    assert one(spark, S.to_number(F.col("t")), t=text) == expected


def test_to_whole_truncates_to_zero(spark):
    assert one(spark, S.to_whole(F.col("t")), t="-7.9") == -7
    assert one(spark, S.to_whole(F.col("t")), t="1e30") is None


@pytest.mark.parametrize("text, expected", [
    ("2026-02-03T10:00:00+00:00", datetime(2026, 2, 3, 10)),
    ("2026-02-03T10:00:00+02:00", datetime(2026, 2, 3, 8)),
    ("2026-02-03", datetime(2026, 2, 3)),
    ("03-02-2026 10:05", datetime(2026, 2, 3, 10, 5)),
    ("03/02/2026", datetime(2026, 2, 3)),
    ("3/2/2026 1:02:03", datetime(2026, 2, 3, 1, 2, 3)),
    ("10:00", None), ("soon", None), ("", None), (None, None), ("2026-13-40", None),
])
def test_parse_timestamp(spark, text, expected):
    assert one(spark, S.parse_timestamp(F.col("t")), t=text) == expected


def test_history_timestamp_falls_back_per_row(spark):
    rows = spark.createDataFrame([("01-06-2023 00:10:00",), ("2023-06-01T01:00:00",), ("x",)], "t string")
    assert [r[0] for r in rows.select(S.parse_history_timestamp(F.col("t"))).collect()] == [
        datetime(2023, 6, 1, 0, 10), datetime(2023, 6, 1, 1), None]


def test_first_text_returns_last_as_is(spark):
    chain = S.first_text(F.col("a"), F.col("b"))
    assert one(spark, chain, a="", b="") == ""
    assert one(spark, chain, a="x", b="y") == "x"
    assert one(spark, chain, a=None, b="y") == "y"


def test_delay_rules(spark):
    rows = spark.createDataFrame([(15.0,), (15.5,), (None,)], "m double")
    got = rows.select(S.delayed_or_null(F.col("m")), S.delayed_flag(F.col("m"))).collect()
    assert [tuple(r) for r in got] == [(False, 0), (True, 1), (None, 0)]


def test_calendar_and_buckets(spark):
    ts = F.lit("2024-01-07 23:30:00").cast("timestamp")
    row = spark.range(1).select(
        *[c.alias(n) for n, c in S.calendar_features(ts).items()],
        S.hour_bucket(F.hour(ts)).alias("b"), S.hour_bucket(F.lit(None).cast("int")).alias("nb"),
        S.day_name(ts).alias("d"), S.monday_based_weekday(ts).alias("w"),
    ).first()
    assert tuple(row) == (1, 23, 1, "21h-23h", None, "Sunday", 6)


def _haversine(spark, *points):
    cols = [F.lit(float(p)) for p in points]
    return spark.range(1).select(S.haversine_nm(*cols)).first()[0]


@settings(max_examples=10, deadline=None)
@given(st.floats(-80, 80), st.floats(-180, 180), st.floats(-80, 80), st.floats(-180, 180))
def test_haversine_is_symmetric(spark, a, b, c, d):
    there, back = _haversine(spark, a, b, c, d), _haversine(spark, c, d, a, b)
    assert math.isclose(there, back, rel_tol=1e-9, abs_tol=1e-6)


def test_haversine_values(spark):
    assert _haversine(spark, 48, 2, 48, 2) == 0
    assert abs(_haversine(spark, 0, 0, 0, 180) - math.pi * S.EARTH_RADIUS_NM) < 1e-6


def test_risk_labels(spark):
    rows = spark.createDataFrame(
        [(True, None), (False, None), (True, 0.7), (True, 0.4), (True, 0.39)], "d boolean, p double")
    got = [r[0] for r in rows.select(S.risk_label(F.col("d"), F.col("p"))).collect()]
    assert got == ["Delayed", "On time", "High risk of delay", "Medium risk of delay", "Low risk of delay"]


def test_region_and_display(spark):
    assert one(spark, S.timezone_region(F.col("t")), t="America/Argentina/Ushuaia") == "America"
    assert one(spark, S.timezone_region(F.col("t")), t="UTC") == "UTC"
    assert one(spark, S.timezone_region(F.col("t")), t="") is None
    assert one(spark, S.display_value([F.col("a"), F.col("b")]), a="  ", b="v") == "v"
    assert one(spark, S.display_value([F.col("a")]), a=None) == "Not available"


def test_status_message_without_probability(spark):
    message = S.status_message([F.col("s")], [F.col("l")], [F.col("p")], [F.col("d")], [F.col("a")])
    assert one(spark, message, s="active", l="Delayed", p="", d=None, a=None) == (
        "The flight is currently reported as 'active'. The ML model predicts: Delayed.")
    assert one(spark, message, s="late arrival", l=None, p=None, d="5", a=None).startswith("The flight appears")
    assert one(spark, message, s="active", l=None, p=None, d="x", a="9") == (
        "The flight status is currently reported as 'active'.")
    assert one(spark, message, s="active", l=None, p=None, d="5.9", a=None).endswith(
        "Departure delay: 5 min. Arrival delay: 0 min.")


def test_percentage_of_nothing(spark):
    assert spark.range(1).select(S.percentage(F.lit(1), F.lit(3)), S.percentage(F.lit(0), F.lit(0))).first()[:] == (33.33, 0.0)


def test_run_id_shape():
    assert len(S.new_run_id(datetime(2026, 1, 2, 3, 4, 5))) == 25
    assert S.new_run_id(datetime(2026, 1, 2, 3, 4, 5)).startswith("20260102T030405Z_")
