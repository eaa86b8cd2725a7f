"""Punctuality report, history serving and feature queries over v_hist."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness.inputs import history_text, typed_history
from harness.registry import query, stamp
from harness.views import table
from skytally.functions.scalars import DAYS, HOUR_BUCKETS
from skytally.operators.joins import with_origin_point
from skytally.operators.search import option_values
from skytally.plans import bi, features, model, serving

LATE = "delay_minutes > 15"
DAY_NAME = "dayname(filed_dep)"
BUCKET = "printf('%02dh-%02dh', (hour(filed_dep) // 3) * 3, (hour(filed_dep) // 3) * 3 + 2)"
HAVERSINE = """2 * 3440.065 * asin(sqrt(
  pow(sin((radians({b}) - radians({a})) / 2), 2)
  + cos(radians({a})) * cos(radians({b})) * pow(sin((radians({d}) - radians({c})) / 2), 2)))"""


def calendar(spark, sf_dir):
    return bi.with_calendar(typed_history(spark, sf_dir))


@query("fleet_summary", views=("v_hist",), oracle=f"""
SELECT aircraft_type, COUNT(*) AS total_flights, COUNT(*) FILTER (WHERE {LATE}) AS delayed_flights,
       round(100.0 * COUNT(*) FILTER (WHERE {LATE}) / COUNT(*), 6) AS delay_percentage
FROM v_hist GROUP BY aircraft_type HAVING COUNT(*) >= 10""")
def fleet_summary(spark, sf_dir):
    return bi.fleet_summary(typed_history(spark, sf_dir))


@query("bi_kpis", views=("v_hist",), oracle=f"""
SELECT COUNT(*) AS total_flights, COUNT(*) FILTER (WHERE {LATE}) AS delayed_flights,
       COUNT(*) - COUNT(*) FILTER (WHERE {LATE}) AS on_time_flights,
       round(100.0 * COUNT(*) FILTER (WHERE {LATE}) / COUNT(*), 6) AS delay_rate,
       round(100.0 - 100.0 * COUNT(*) FILTER (WHERE {LATE}) / COUNT(*), 6) AS punctuality_rate,
       round(COALESCE(AVG(delay_minutes) FILTER (WHERE {LATE}), 0.0), 6) AS avg_delay_minutes
FROM v_hist""")
def bi_kpis(spark, sf_dir):
    return bi.kpis(bi.filtered(typed_history(spark, sf_dir)))


@query("bi_kpis_selected", views=("v_hist",), oracle=f"""
SELECT COUNT(*) AS total_flights, COUNT(*) AS delayed_flights, CAST(0 AS BIGINT) AS on_time_flights,
       100.0::DOUBLE AS delay_rate, 0.0::DOUBLE AS punctuality_rate,
       round(COALESCE(AVG(delay_minutes), 0.0), 6) AS avg_delay_minutes
FROM v_hist WHERE {LATE} AND operator IN ('OP01', 'OP05', 'OP07') AND aircraft_type IS NOT NULL""")
def bi_kpis_selected(spark, sf_dir):
    chosen = bi.filtered(typed_history(spark, sf_dir), ["OP01", "OP05", "OP07"], status="delayed")
    return bi.kpis(chosen)


@query("delays_by_operator", views=("v_hist",), oracle=f"""
SELECT operator, CASE WHEN {LATE} THEN 'Delayed' ELSE 'On-Time' END AS status, COUNT(*) AS count
FROM v_hist WHERE delay_minutes IS NOT NULL GROUP BY 1, 2""")
def delays_by_operator(spark, sf_dir):
    return bi.delays_by_operator(typed_history(spark, sf_dir))


@query("top10_routes_volume", views=("v_hist",), oracle="""
SELECT origin || ' → ' || destination AS route, COUNT(*) AS count
FROM v_hist GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top10_routes_volume(spark, sf_dir):
    return bi.top_routes(typed_history(spark, sf_dir))


@query("weekday_share", views=("v_hist",), oracle=f"""
SELECT {DAY_NAME} AS day_name, CASE WHEN {LATE} THEN 'Delayed' ELSE 'On-Time' END AS status,
       COUNT(*) AS count,
       round(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY {DAY_NAME}), 6) AS percentage
FROM v_hist WHERE delay_minutes IS NOT NULL
GROUP BY {DAY_NAME}, CASE WHEN {LATE} THEN 'Delayed' ELSE 'On-Time' END""")
def weekday_share(spark, sf_dir):
    return bi.weekday_share(calendar(spark, sf_dir))


@query("hour_volume", views=("v_hist",), oracle=f"""
SELECT hour(filed_dep) AS hour, CASE WHEN {LATE} THEN 'Delayed' ELSE 'On-Time' END AS status,
       COUNT(*) AS count
FROM v_hist WHERE delay_minutes IS NOT NULL GROUP BY 1, 2""")
def hour_volume(spark, sf_dir):
    return bi.hour_volume(calendar(spark, sf_dir))


@query("heatmap_cells", views=("v_hist",), oracle=f"""
SELECT {BUCKET} AS hour_group, {DAY_NAME} AS day_name, COUNT(*) AS total_flights,
       COUNT(*) FILTER (WHERE {LATE}) AS delayed_flights,
       round(100.0 * COUNT(*) FILTER (WHERE {LATE}) / COUNT(*), 6) AS delay_pct
FROM v_hist GROUP BY 1, 2""")
def heatmap_cells(spark, sf_dir):
    return bi.heatmap_cells(calendar(spark, sf_dir))


def _pivot_oracle(value: str) -> str:
    days = ", ".join(
        f"COALESCE(MAX(v) FILTER (WHERE day_name = '{d}'), 0.0) AS \"{d}\"" for d in DAYS
    )
    buckets = ", ".join(f"('{b}')" for b in HOUR_BUCKETS)
    return f"""
WITH cells AS (SELECT {BUCKET} AS hour_group, {DAY_NAME} AS day_name, {value} AS v
               FROM v_hist GROUP BY 1, 2)
SELECT b.hour_group, {days}
FROM (VALUES {buckets}) b(hour_group) LEFT JOIN cells USING (hour_group) GROUP BY b.hour_group"""


@query("heatmap_pivot", views=("v_hist",), oracle=_pivot_oracle(
    f"round(100.0 * COUNT(*) FILTER (WHERE {LATE}) / COUNT(*), 6)"))
def heatmap_pivot(spark, sf_dir):
    return bi.heatmap_pivot(bi.heatmap_cells(calendar(spark, sf_dir)))


@query("heatmap_pivot_flights", views=("v_hist",), oracle=_pivot_oracle("CAST(COUNT(*) AS DOUBLE)"))
def heatmap_pivot_flights(spark, sf_dir):
    return bi.heatmap_pivot(bi.heatmap_cells(calendar(spark, sf_dir)), "total_flights")


@query("option_lists", views=("v_hist", "v_obs"), oracle="""
SELECT DISTINCT 'operator' AS list, operator AS option FROM v_hist WHERE operator IS NOT NULL
UNION ALL
SELECT DISTINCT 'aircraft_type', aircraft_type FROM v_hist WHERE aircraft_type IS NOT NULL
UNION ALL
SELECT DISTINCT 'flight_status', flight_status FROM v_obs WHERE flight_status IS NOT NULL""")
def option_lists(spark, sf_dir):
    hist = typed_history(spark, sf_dir)
    lists = [
        option_values(df, name).select(F.lit(name).alias("list"), "option")
        for df, name in (
            (hist, "operator"), (hist, "aircraft_type"), (table(spark, sf_dir, "v_obs"), "flight_status"),
        )
    ]
    return lists[0].unionByName(lists[1]).unionByName(lists[2])


@query("historical_analytics", views=("v_hist",), oracle=f"""
SELECT CAST(flight_id AS VARCHAR) AS flight_id, ' ' || lower(operator) AS operator, aircraft_type,
       origin, destination, strftime(filed_dep, '%d-%m-%Y %H:%M:%S') AS filed_dep_time,
       COALESCE(strftime(filed_dep + delay_minutes * INTERVAL '1' MINUTE, '%d-%m-%Y %H:%M:%S'), '') AS actual_dep_time,
       round(CAST(requested_fl AS DOUBLE), 6) AS distance_nm, CAST(delay_minutes AS DOUBLE) AS delay_minutes,
       {LATE} AS is_delayed
FROM v_hist WHERE origin LIKE 'LF%' AND destination LIKE 'LF%'""")
def historical_analytics(spark, sf_dir):
    return serving.historical_analytics(history_text(spark, sf_dir))


@query("historical_analytics_operator", views=("v_hist",), oracle=f"""
SELECT origin, destination, COUNT(*) AS flights, COUNT(*) FILTER (WHERE {LATE}) AS late,
       COUNT(*) FILTER (WHERE delay_minutes IS NULL) AS unknown
FROM v_hist WHERE origin LIKE 'LF%' AND destination LIKE 'LF%' AND operator = 'OP03' GROUP BY 1, 2""")
def historical_analytics_operator(spark, sf_dir):
    rows = serving.historical_analytics(history_text(spark, sf_dir), operator=" op03")
    return rows.groupBy("origin", "destination").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if("is_delayed").alias("late"),
        F.count_if(F.col("is_delayed").isNull()).alias("unknown"),
    )


@query("hist_features", views=("v_hist",), oracle=f"""
SELECT CAST(flight_id AS VARCHAR) AS "ECTRL ID", CAST(delay_minutes AS DOUBLE) AS departure_delay_min,
       CAST(COALESCE({LATE}, FALSE) AS BIGINT) AS is_delayed, month(filed_dep) AS month, hour(filed_dep) AS hour,
       dayofweek(filed_dep) + 1 AS day_of_week, adep_lat AS "Latitude", adep_lon AS "Longitude",
       round({HAVERSINE.format(a='adep_lat', b='ades_lat', c='adep_lon', d='ades_lon')}, 6) AS "Actual Distance Flown (nm)",
       round(CAST(requested_fl AS DOUBLE), 6) AS "Requested FL", operator AS "AC Operator"
FROM v_hist WHERE origin LIKE 'LF%' AND destination LIKE 'LF%'""")
def hist_features(spark, sf_dir):
    return features.history_features(history_text(spark, sf_dir)).select(
        "ECTRL ID", "departure_delay_min", "is_delayed", "month", "hour", "day_of_week", "Latitude",
        "Longitude", "`Actual Distance Flown (nm)`", "Requested FL", "AC Operator",
    )


@query("hist_features_recorded", views=("v_hist",), oracle=f"""
SELECT operator AS "AC Operator", COUNT(*) AS flights, CAST(SUM(CASE WHEN {LATE} THEN 1 ELSE 0 END) AS BIGINT) AS late,
       round(AVG(CAST(requested_fl AS DOUBLE)), 6) AS distance
FROM v_hist WHERE origin LIKE 'LF%' AND destination LIKE 'LF%' GROUP BY operator""")
def hist_features_recorded(spark, sf_dir):
    rows = features.history_features(history_text(spark, sf_dir), True, use_route_distance=False)
    return rows.groupBy("AC Operator").agg(
        F.count(F.lit(1)).alias("flights"), F.sum("is_delayed").alias("late"),
        F.avg("`Actual Distance Flown (nm)`").alias("distance"),
    )


@query("class_distribution", views=("v_hist",), oracle=f"""
SELECT CAST(COALESCE({LATE}, FALSE) AS BIGINT) AS is_delayed, COUNT(*) AS count,
       round(COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER (), 6) AS share
FROM v_hist WHERE origin LIKE 'LF%' AND destination LIKE 'LF%' GROUP BY 1""")
def class_distribution(spark, sf_dir):
    return model.class_distribution(features.history_features(history_text(spark, sf_dir), True))


@query("origin_point_join", views=("v_hist", "v_points"), oracle="""
SELECT CAST(h.flight_id AS VARCHAR) AS "ECTRL ID", h.operator, p.latitude AS "Latitude",
       round(p.longitude, 6) AS "Longitude"
FROM v_hist h JOIN v_points p ON p.flight_id = h.flight_id AND p.sequence_number = 0""")
def origin_point_join(spark, sf_dir):
    flights = typed_history(spark, sf_dir).select(
        F.col("flight_id").cast("string").alias("ECTRL ID"), "operator"
    )
    return with_origin_point(flights, points(spark, sf_dir))


def points(spark, sf_dir):
    return table(spark, sf_dir, "v_points").select(
        F.col("flight_id").cast("string").alias("ECTRL ID"),
        F.col("sequence_number").alias("Sequence Number"),
        F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"),
    )


@query("trajectory_features", views=("v_hist", "v_points"), oracle=f"""
SELECT h.operator AS "AC Operator", month(filed_dep) AS month, COUNT(*) AS flights,
       COUNT(*) FILTER (WHERE {LATE}) AS late, round(AVG(p.latitude), 6) AS latitude
FROM v_hist h JOIN v_points p ON p.flight_id = h.flight_id AND p.sequence_number = 0 GROUP BY 1, 2""")
def trajectory_features(spark, sf_dir):
    history = history_text(spark, sf_dir).withColumn("AC Operator", F.upper(F.trim("AC Operator")))
    history = history.withColumns({
        c: F.nullif(F.col(c), F.lit("")) for c in ("ACTUAL OFF BLOCK TIME", "FILED OFF BLOCK TIME")
    })
    return features.trajectory_features(history, points(spark, sf_dir)).groupBy(
        "AC Operator", "month"
    ).agg(
        F.count(F.lit(1)).alias("flights"), F.sum("is_delayed").alias("late"),
        F.avg("Latitude").alias("latitude"),
    )


@query("history_calendar", views=("v_hist",), oracle=f"""
SELECT {DAY_NAME} AS day_name, isodow(filed_dep) - 1 AS day_of_week, {BUCKET} AS hour_group,
       COUNT(*) AS flights, {stamp('MIN(filed_dep)')} AS first_filed
FROM v_hist GROUP BY 1, 2, 3""")
def history_calendar(spark, sf_dir):
    text = history_text(spark, sf_dir).select(F.col("FILED OFF BLOCK TIME").alias("filed_dep_time"))
    return bi.with_calendar(text).groupBy("day_name", "day_of_week", "hour_group").agg(
        F.count(F.lit(1)).alias("flights"), F.min("filed_dep_time").alias("first_filed")
    )
