"""Document, snapshot, route, coordinate and serving queries over v_obs and v_pred."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness import inputs
from harness.bi_queries import HAVERSINE
from harness.registry import query, stamp
from harness.views import table
from skytally import schemas
from skytally.functions import records as R
from skytally.functions import scalars as S
from skytally.operators import search
from skytally.operators.joins import lookup_coordinates, broadcast_if_small, on_followed_routes
from skytally.plans import explorer, features, insights, serving
from skytally.sources.csv_files import airport_coordinates
from skytally.sources.payloads import combine_pages, ledger_rows, page_totals, unprocessed

ORDINAL = "loaded_seq"


def in_list(codes) -> str:
    return "(" + ", ".join(f"'{c}'" for c in codes) + ")"


FRENCH = in_list(R.FRENCH_IATA)


# --- unwrapping and keys ---------------------------------------------------------------------

RECORDS_PER_SHAPE = {
    "flights": [1, 2, 3, 1, 0, 1, 4],
    "reference": [1, 2, 2, 1, 0, 1, 4],
    "insights": [1, 1, 2, 1, 0, 1, 3],
    "features": [1, 1, 2, 1, 0, 1, 3],
    "extractor": [1, 1, 0, 0, 0, 0, 0],
}
_EXPECTED = ", ".join(
    f"('{mode}', {shape}, {n})"
    for mode, per_shape in RECORDS_PER_SHAPE.items() for shape, n in enumerate(per_shape) if n
)


@query("unwrap_records", oracle=f"""
SELECT e.mode, CAST(e.shape AS BIGINT) AS shape, CAST(SUM(e.n) AS BIGINT) AS records,
       COUNT(DISTINCT event_id) AS payloads
FROM events JOIN (VALUES {_EXPECTED}) e(mode, shape, n) ON events.event_id % 7 = e.shape
GROUP BY 1, 2""")
def unwrap_records(spark, sf_dir):
    payloads = inputs.payloads(spark, sf_dir)
    counted = [
        R.unwrap(payloads, mode).groupBy("shape").agg(
            F.count(F.lit(1)).alias("records"), F.count_distinct("event_id").alias("payloads")
        ).withColumn("mode", F.lit(mode))
        for mode in R.UNWRAP_MODES
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


@query("combine_pages", oracle="""
SELECT COUNT(*) AS "limit", CAST(0 AS BIGINT) AS "offset", COUNT(*) AS count, COUNT(*) AS total
FROM events WHERE event_id % 7 = 0""")
def combined_pages(spark, sf_dir):
    # Only payloads with a ``data`` array add items; which those are is decided from the payload.
    return page_totals(combine_pages(inputs.payloads(spark, sf_dir)))


@query("flight_keys_valid", views=("v_obs",), oracle="""
SELECT CAST(CAST(departure_scheduled AS DATE) AS VARCHAR) AS flight_date, flight_iata AS flight_number,
       departure_iata, arrival_iata, airline_iata, TRUE AS is_valid, COUNT(*) AS records
FROM v_obs GROUP BY ALL""")
def flight_keys_valid(spark, sf_dir):
    keyed = R.with_keys(inputs.documents(spark, sf_dir), "flights")
    return keyed.groupBy(*R.FLIGHT_KEY, "is_valid").agg(F.count(F.lit(1)).alias("records"))


@query("flight_keys_fallback", views=("v_obs",), oracle="""
WITH cut AS (
  SELECT *, CASE event_id % 5 WHEN 0 THEN flight_iata WHEN 1 THEN 'X' || flight_iata
                              WHEN 2 THEN substr(flight_iata, 2) WHEN 3 THEN '' END AS number
  FROM v_obs)
SELECT number AS flight_number, number IS NOT NULL AS is_valid, COUNT(*) AS records
FROM cut GROUP BY ALL""")
def flight_keys_fallback(spark, sf_dir):
    shape = F.col("event_id") % 5
    text = F.to_json(F.struct(
        F.lit("2024-01-01").alias("flight_date"),
        F.when(shape < 4, F.struct(
            F.when(shape == 0, F.col("flight_iata")).otherwise("").alias("iata"),
            F.when(shape == 1, F.concat(F.lit("X"), "flight_iata")).alias("icao"),
            F.when(shape == 2, F.substring("flight_iata", 2, 99)).otherwise("").alias("number"),
        )).alias("flight"),
    ))
    docs = table(spark, sf_dir, "v_obs").select(F.parse_json(text).alias("doc"))
    return R.with_keys(docs, "flights").groupBy("flight_number", "is_valid").agg(
        F.count(F.lit(1)).alias("records")
    )


@query("dim_keys_valid", views=("v_airports",), oracle="""
SELECT e.user_id % 25 AS nation, a.iata_code AS airport_iata,
       CASE WHEN e.event_id % 3 = 0 THEN a.icao_code END AS airport_icao,
       CASE WHEN e.event_id % 5 = 0 THEN a.ident END AS airport_name,
       (a.iata_code IS NOT NULL OR e.event_id % 3 = 0 OR e.event_id % 5 = 0) AS is_valid, COUNT(*) AS records
FROM events e JOIN v_airports a ON a.row_ix = e.user_id % 25 GROUP BY ALL""")
def dim_keys_valid(spark, sf_dir):
    airports = table(spark, sf_dir, "v_airports")
    events = table(spark, sf_dir, "v_obs").select("event_id", (F.col("user_id") % 25).alias("row_ix"))
    rows = events.join(broadcast_if_small(airports), "row_ix")
    doc = F.parse_json(F.to_json(F.struct(
        F.col("iata_code"),
        F.when(F.col("event_id") % 3 == 0, F.col("icao_code")).alias("icao_code"),
        F.when(F.col("event_id") % 5 == 0, F.col("ident")).alias("airport_name"),
    )))
    keyed = R.with_keys(rows.select(F.col("row_ix").alias("nation"), doc.alias("doc")), "airports")
    return keyed.groupBy("nation", *R.AIRPORT_KEY, "is_valid").agg(F.count(F.lit(1)).alias("records"))


# --- extractor -------------------------------------------------------------------------------

IN_AIR = f"""departure_iata IN {FRENCH} AND arrival_iata IN {FRENCH}
  AND CASE WHEN live_is_ground IS NOT NULL THEN NOT live_is_ground
           ELSE COALESCE(flight_status = 'active', FALSE) END"""


@query("in_air_domestic", views=("v_obs",), oracle=f"""
SELECT event_id, flight_iata, departure_iata, arrival_iata, flight_status FROM v_obs WHERE {IN_AIR}""")
def in_air_domestic(spark, sf_dir):
    doc = F.parse_json("doc")
    return insights.in_air_domestic(inputs.documents(spark, sf_dir)).select(
        "event_id", R.text_at(doc, "flight.iata").alias("flight_iata"),
        R.text_at(doc, "departure.iata").alias("departure_iata"),
        R.text_at(doc, "arrival.iata").alias("arrival_iata"),
        R.text_at(doc, "flight_status").alias("flight_status"),
    )


@query("extractor_metrics", views=("v_obs",), oracle=f"""
SELECT COUNT(*) AS raw_count, COUNT(*) FILTER (WHERE {IN_AIR}) AS extracted_count,
       COUNT(DISTINCT run_id) AS pages_fetched FROM v_obs""")
def extractor_metrics(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    return insights.extractor_metrics(docs, insights.in_air_domestic(docs), page="run_id")


@query("route_allowlist_semi", views=("v_obs",), oracle=f"""
SELECT event_id, departure_iata, arrival_iata FROM v_obs
WHERE flight_status = 'scheduled' AND (departure_iata, arrival_iata) IN
  ({", ".join(f"('{a}', '{b}')" for a, b in R.FOLLOWED_ROUTES)})""")
def route_allowlist_semi(spark, sf_dir):
    rows = on_followed_routes(
        table(spark, sf_dir, "v_obs"), R.FOLLOWED_ROUTES, "departure_iata", "arrival_iata",
        "flight_status",
    )
    return rows.select("event_id", "departure_iata", "arrival_iata")


PRUNABLE = """named_struct(
  'id', event_id, 'status', coalesce(flight_status, ''), 'iata', departure_iata,
  'delay', departure_delay,
  'live', named_struct('is_ground', live_is_ground, 'note', ''),
  'tags', array('', airline_iata, NULL),
  'empty', named_struct('list', array(''), 'text', ''))"""


@query("prune_docs", views=("v_obs",), oracle="""
SELECT event_id, 1 + (flight_status IS NOT NULL)::INT + (departure_iata <> '')::INT
         + (departure_delay IS NOT NULL)::INT + (live_is_ground IS NOT NULL)::INT
         + (airline_iata IS NOT NULL)::INT AS keys,
       flight_status AS status, departure_delay AS delay, live_is_ground AS is_ground,
       CASE WHEN airline_iata IS NOT NULL THEN '["' || airline_iata || '"]' END AS tags
FROM v_obs""")
def prune_docs(spark, sf_dir):
    rows = table(spark, sf_dir, "v_obs").withColumn("record", F.expr(PRUNABLE))
    left = R.pruned_json(F.col("record"), rows.schema["record"].dataType)
    doc = F.parse_json(left)
    return rows.select("event_id", doc.alias("doc"), left.alias("text")).select(
        "event_id", F.json_object_keys("text").alias("k"), "doc"
    ).select(
        "event_id", F.size("k").alias("keys"), R.text_at(F.col("doc"), "status").alias("status"),
        F.try_variant_get("doc", F.lit("$.delay"), "bigint").alias("delay"),
        F.try_variant_get("doc", F.lit("$.live.is_ground"), "boolean").alias("is_ground"),
        F.to_json(R.at(F.col("doc"), "tags")).alias("tags"),
    )


# --- snapshot and routes ---------------------------------------------------------------------

DEP_LATE = "(event_id % 6 <> 2 AND departure_delay > 0)"  # text delays are not numbers
SNAPSHOT_SQL = f"""
SELECT run_id, 'aviationstack' AS source, 'flights' AS endpoint, COUNT(*) AS observed_flights_total,
  COUNT(*) FILTER (WHERE flight_status = 'active') AS observed_flights_active,
  COUNT(*) FILTER (WHERE flight_status = 'scheduled') AS observed_flights_scheduled,
  COUNT(*) FILTER (WHERE flight_status = 'landed') AS observed_flights_landed,
  COUNT(*) FILTER (WHERE flight_status = 'cancelled') AS observed_flights_cancelled,
  CAST(0 AS BIGINT) AS observed_flights_diverted, CAST(0 AS BIGINT) AS observed_flights_incident,
  COUNT(*) FILTER (WHERE flight_status IS NULL) AS observed_flights_unknown,
  round(100.0 * COUNT(*) FILTER (WHERE flight_status = 'active') / COUNT(*), 2) AS observed_flights_active_pct,
  COUNT(*) FILTER (WHERE {DEP_LATE}) AS observed_departure_delays_total,
  COUNT(*) FILTER (WHERE arrival_delay > 0) AS observed_arrival_delays_total,
  COUNT(*) FILTER (WHERE {DEP_LATE} OR arrival_delay > 0) AS observed_delayed_flights_total,
  COUNT(DISTINCT nullif(airline_iata, '')) AS observed_unique_airlines,
  COUNT(DISTINCT nullif(departure_iata, '') || '-' || nullif(arrival_iata, '')) AS observed_unique_routes,
  COUNT(DISTINCT nullif(departure_iata, '')) AS observed_unique_departure_airports,
  COUNT(DISTINCT nullif(arrival_iata, '')) AS observed_unique_arrival_airports
FROM v_obs GROUP BY run_id"""


@query("snapshot_insights", views=("v_obs",), oracle=SNAPSHOT_SQL)
def snapshot_insights(spark, sf_dir):
    return insights.snapshot_insights(inputs.documents(spark, sf_dir))


@query("latest_snapshot", views=("v_obs",), oracle=f"""
SELECT {stamp('MAX(departure_scheduled)')} AS time, COUNT(*) AS observed_flights_total,
       COUNT(*) FILTER (WHERE flight_status = 'active') AS observed_flights_active,
       COUNT(*) FILTER (WHERE {DEP_LATE} OR arrival_delay > 0) AS observed_delayed_flights_total
FROM v_obs WHERE run_id = (SELECT MAX(run_id) FROM v_obs)""")
def latest_snapshot(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    seen = S.parse_timestamp(R.text_at(F.col("doc"), "departure.scheduled"))
    times = docs.groupBy("run_id").agg(F.max(seen).alias("snapshot_at"))
    return insights.latest_snapshot(insights.snapshot_insights(docs).join(times, "run_id"))


def routes(spark, sf_dir):
    records = inputs.documents(spark, sf_dir).withColumns(
        {"record_ix": F.lit(0), "loaded_seq": F.col("event_id")}
    )
    return insights.flatten_routes(records)


LATEST_RUN = "run_id = (SELECT arg_max(run_id, event_id) FROM v_obs)"
REGION = "nullif(split_part({c}, '/', 1), '')"


@query("flatten_routes", views=("v_obs",), oracle=f"""
SELECT event_id AS loaded_seq, run_id, 'aviationstack' AS source, 'flights' AS endpoint,
  CAST(CAST(departure_scheduled AS DATE) AS VARCHAR) AS flight_date, substr(flight_iata, 2) AS flight_number,
  flight_iata, 'X' || flight_iata AS flight_icao, flight_status, 'Line ' || airline_iata AS airline_name, airline_iata,
  nullif(departure_iata, '') AS departure_iata, departure_icao, departure_timezone, {REGION.format(c='departure_timezone')} AS departure_region,
  arrival_iata, arrival_timezone, {REGION.format(c='arrival_timezone')} AS arrival_region,
  {stamp('departure_scheduled')} AS departure_scheduled, CAST(NULL AS VARCHAR) AS arrival_actual
FROM v_obs""")
def flatten_routes(spark, sf_dir):
    return routes(spark, sf_dir).select(
        "loaded_seq", "run_id", "source", "endpoint", "flight_date", "flight_number", "flight_iata",
        "flight_icao", "flight_status", "airline_name", "airline_iata", "departure_iata",
        "departure_icao", "departure_timezone", "departure_region", "arrival_iata",
        "arrival_timezone", "arrival_region", "departure_scheduled", "arrival_actual",
    )


@query("latest_route_count", views=("v_obs",), oracle=f"SELECT COUNT(*) AS total_routes FROM v_obs WHERE {LATEST_RUN}")
def latest_route_count(spark, sf_dir):
    return insights.latest_route_count(routes(spark, sf_dir), ORDINAL)


@query("region_flows_latest", views=("v_obs",), oracle=f"""
SELECT {REGION.format(c='departure_timezone')} || ' → ' || {REGION.format(c='arrival_timezone')} AS route_region,
       COUNT(*) AS flights
FROM v_obs WHERE {LATEST_RUN} AND departure_timezone IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def region_flows_latest(spark, sf_dir):
    return insights.region_flows(routes(spark, sf_dir), ORDINAL)


@query("latest_routes_table", views=("v_obs",), oracle=f"""
SELECT CAST(CAST(departure_scheduled AS DATE) AS VARCHAR) AS flight_date, run_id,
       CAST(NULL AS VARCHAR) AS aircraft_icao24, airline_iata, flight_iata, nullif(departure_iata, '') AS departure_iata,
       {REGION.format(c='departure_timezone')} AS departure_region, arrival_iata,
       {REGION.format(c='arrival_timezone')} AS arrival_region, flight_status
FROM v_obs WHERE {LATEST_RUN}
ORDER BY date_trunc('second', departure_scheduled) NULLS LAST, flight_iata NULLS LAST, event_id LIMIT 100""")
def latest_routes_table(spark, sf_dir):
    return insights.latest_routes(routes(spark, sf_dir), ORDINAL, ties=("loaded_seq",))


@query("archive_ledger", views=("v_obs",), oracle="""
SELECT DISTINCT 'aviationstack_flights_incoming_' || run_id || '.json' AS file_name
FROM v_obs WHERE run_id > (SELECT quantile_disc(run_id, 0.5) FROM (SELECT DISTINCT run_id FROM v_obs))""")
def archive_ledger(spark, sf_dir):
    files = table(spark, sf_dir, "v_obs").select(
        "run_id", F.format_string("aviationstack_flights_incoming_%s.json", "run_id").alias("file_name")
    ).distinct()
    middle = files.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY CAST(run_id AS INT))").cast("int"))
    done = files.where(F.col("run_id").cast("int") <= middle.scalar())
    return unprocessed(files, ledger_rows(done, "r1")).select("file_name")


# --- coordinates and live features -----------------------------------------------------------

COORDINATES_SQL = """codes AS (
  SELECT row_ix, 0 AS col_ix, iata_code AS code, latitude_deg, longitude_deg FROM v_airports WHERE iso_country = 'FR' AND iata_code IS NOT NULL
  UNION ALL SELECT row_ix, 1, icao_code, latitude_deg, longitude_deg FROM v_airports WHERE iso_country = 'FR' AND iata_code IS NOT NULL
  UNION ALL SELECT row_ix, 2, gps_code, latitude_deg, longitude_deg FROM v_airports WHERE iso_country = 'FR' AND iata_code IS NOT NULL
  UNION ALL SELECT row_ix, 3, ident, latitude_deg, longitude_deg FROM v_airports WHERE iso_country = 'FR' AND iata_code IS NOT NULL),
coords AS (
  SELECT code, latitude_deg AS latitude, longitude_deg AS longitude
  FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY row_ix, col_ix) AS rn FROM codes WHERE code IS NOT NULL)
  WHERE rn = 1)"""


def coordinates(spark, sf_dir):
    airports = table(spark, sf_dir, "v_airports")
    as_text = [F.col(c).cast("string").alias(c) for c in airports.columns if c != "row_ix"]
    return airport_coordinates(airports.select("row_ix", *as_text))


@query("coord_first_wins", views=("v_airports",), oracle=f"WITH {COORDINATES_SQL} SELECT code, latitude, longitude FROM coords")
def coord_first_wins(spark, sf_dir):
    return coordinates(spark, sf_dir)


@query("coord_lookup", views=("v_airports", "v_obs"), oracle=f"""
WITH {COORDINATES_SQL}
SELECT o.event_id, COALESCE(i.latitude, c.latitude) AS latitude, COALESCE(i.longitude, c.longitude) AS longitude
FROM v_obs o LEFT JOIN coords i ON i.code = o.departure_iata LEFT JOIN coords c ON c.code = o.departure_icao""")
def coord_lookup(spark, sf_dir):
    rows = table(spark, sf_dir, "v_obs").select("event_id", "departure_iata", "departure_icao")
    places = broadcast_if_small(coordinates(spark, sf_dir))
    found = lookup_coordinates(rows, places, ["departure_iata", "departure_icao"], "at")
    return found.select("event_id", "at.latitude", "at.longitude")


LIVE_SQL = f"""WITH {COORDINATES_SQL},
live AS (
  SELECT o.event_id, o.flight_iata, o.departure_scheduled, COALESCE(i.latitude, c.latitude) AS lat,
         COALESCE(i.longitude, c.longitude) AS lon, a.latitude AS lat2, a.longitude AS lon2,
         upper(COALESCE(airline_iata, 'Line ' || airline_iata)) AS operator
  FROM v_obs o LEFT JOIN coords i ON i.code = o.departure_iata LEFT JOIN coords c ON c.code = o.departure_icao
  LEFT JOIN coords a ON a.code = o.arrival_iata
  WHERE o.departure_iata IN {FRENCH} AND o.arrival_iata IN {FRENCH}),
done AS (SELECT * FROM live WHERE lat IS NOT NULL AND lat2 IS NOT NULL AND operator IS NOT NULL)
"""


@query("live_features", views=("v_airports", "v_obs"), oracle=LIVE_SQL + f"""
SELECT event_id, lat AS "Latitude", lon AS "Longitude", CAST(350 AS BIGINT) AS "Requested FL",
       round({HAVERSINE.format(a='lat', b='lat2', c='lon', d='lon2')}, 6) AS "Actual Distance Flown (nm)",
       operator AS "AC Operator", month(departure_scheduled) AS month, hour(departure_scheduled) AS hour,
       dayofweek(departure_scheduled) + 1 AS day_of_week FROM done""")
def live_features(spark, sf_dir):
    rows = features.live_features(inputs.documents(spark, sf_dir), coordinates(spark, sf_dir))
    return rows.select("event_id", *[F.col(f"`{c}`") for c in schemas.FEATURES])


@query("serving_records", views=("v_airports", "v_obs"), oracle=LIVE_SQL + f"""
SELECT d.flight_iata, 'X' || d.flight_iata AS flight_icao, substr(d.flight_iata, 2) AS flight_number,
       CAST(CAST(d.departure_scheduled AS DATE) AS VARCHAR) AS flight_date, o.flight_status, o.airline_iata,
       o.departure_iata, o.arrival_iata, {stamp('d.departure_scheduled')} AS departure_scheduled,
       nullif(o.departure_delay, CASE WHEN o.event_id % 6 = 2 THEN NULL ELSE 0 END) AS departure_delay_min,
       nullif(o.arrival_delay, 0) AS arrival_delay_min, o.live_is_ground, d.lat AS model_latitude,
       month(d.departure_scheduled) AS model_month, hour(d.departure_scheduled) >= 12 AS predicted_is_delayed,
       CASE WHEN hour(d.departure_scheduled) >= 18 THEN 'High risk of delay' WHEN hour(d.departure_scheduled) >= 12
            THEN 'Medium risk of delay' ELSE 'Low risk of delay' END AS prediction_label
FROM done d JOIN v_obs o USING (event_id)""")
def serving_records(spark, sf_dir):
    rows = features.live_features(inputs.documents(spark, sf_dir), coordinates(spark, sf_dir))
    scored = rows.withColumns({
        "predicted_is_delayed": F.col("hour") >= 12,
        "delay_probability": F.when(F.col("hour") >= 18, 0.9).when(F.col("hour") >= 12, 0.5).otherwise(0.1),
    })
    records = serving.serving_records(scored, "m", "v1", F.current_timestamp())
    return records.select(
        "flight_iata", "flight_icao", "flight_number", "flight_date", "flight_status",
        "airline_iata", "departure_iata", "arrival_iata", "departure_scheduled",
        "departure_delay_min", "arrival_delay_min", "live_is_ground", "model_latitude",
        "model_month", "predicted_is_delayed", "prediction_label",
    )


@query("live_and_operational_info", views=("v_obs",), oracle=f"""
SELECT event_id, flight_iata, 'X' || flight_iata AS flight_icao, nullif(departure_iata, '') AS departure_iata,
       departure_icao, arrival_iata, CAST(NULL AS VARCHAR) AS arrival_icao, upper(airline_iata) AS airline_operator,
       {stamp('departure_scheduled')} AS departure_scheduled, live_is_ground, CAST(NULL AS DOUBLE) AS live_latitude
FROM v_obs""")
def live_and_operational_info(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    info = {**serving.operational_info(F.col("doc")), **serving.live_info(F.col("doc"))}
    names = [
        "flight_iata", "flight_icao", "departure_iata", "departure_icao", "arrival_iata",
        "arrival_icao", "airline_operator", "departure_scheduled", "live_is_ground", "live_latitude",
    ]
    return docs.select("event_id", *[info[n].alias(n) for n in names])


# --- serving queries over predictions --------------------------------------------------------


@query("business_kpis", views=("v_pred",), oracle="""
SELECT COUNT(*) AS observed_flights, COUNT(*) FILTER (WHERE lower(flight_status) = 'active') AS active_flights,
       COUNT(*) FILTER (WHERE lower(flight_status) = 'landed') AS landed_flights,
       COUNT(*) FILTER (WHERE predicted_is_delayed) AS predicted_delayed_flights, COUNT(*) AS route_records
FROM v_pred""")
def business_kpis(spark, sf_dir):
    return serving.business_kpis(table(spark, sf_dir, "v_pred"))


@query("status_summary", views=("v_pred",), oracle="""
SELECT COALESCE(flight_status, 'unknown') AS flight_status, COUNT(*) AS flights FROM v_pred GROUP BY 1""")
def status_summary(spark, sf_dir):
    return serving.status_summary(table(spark, sf_dir, "v_pred"))


@query("top_routes", views=("v_pred",), oracle="""
SELECT COALESCE(departure_iata, 'unknown') AS departure_iata, COALESCE(arrival_iata, 'unknown') AS arrival_iata,
       COUNT(*) AS flights, COUNT(*) FILTER (WHERE predicted_is_delayed) AS predicted_delayed_flights,
       round(AVG(delay_probability), 6) AS avg_delay_probability
FROM v_pred GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""")
def top_routes(spark, sf_dir):
    return serving.top_routes(table(spark, sf_dir, "v_pred"))


PRED_COLUMNS = ["event_id", "flight_iata", "flight_icao", "flight_status", "prediction_created_at", "departure_scheduled"]
PRED_SELECT = f"""SELECT event_id, flight_iata, flight_icao, flight_status,
  {stamp('prediction_created_at')} AS prediction_created_at, {stamp('departure_scheduled')} AS departure_scheduled"""
NEWEST = "ORDER BY v_pred.prediction_created_at DESC NULLS LAST, v_pred.departure_scheduled DESC NULLS LAST, event_id"


@query("latest_flights", views=("v_pred",), oracle=f"{PRED_SELECT} FROM v_pred {NEWEST} LIMIT 20")
def latest_flights(spark, sf_dir):
    return serving.latest_flights(table(spark, sf_dir, "v_pred"), ties=("event_id",)).select(PRED_COLUMNS)


@query("search_flights_ilike", views=("v_pred",), oracle=f"""
{PRED_SELECT} FROM v_pred WHERE flight_iata ILIKE '%a_1%' OR flight_icao ILIKE '%a_1%' {NEWEST} LIMIT 50""")
def search_flights_ilike(spark, sf_dir):
    rows = serving.search_flights(table(spark, sf_dir, "v_pred"), " a_1 ", 50, ties=("event_id",))
    return rows.select(PRED_COLUMNS)


@query("search_raw_regex", views=("v_obs",), oracle="""
SELECT event_id FROM v_obs
WHERE regexp_matches(flight_iata, '^a.*7$', 'i') OR regexp_matches('X' || flight_iata, '^a.*7$', 'i')
   OR regexp_matches(substr(flight_iata, 2), '^a.*7$', 'i') ORDER BY event_id LIMIT 50""")
def search_raw_regex(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    return serving.search_documents(docs, "^a.*7$", 50, order=("event_id",)).select("event_id")


@query("search_mask_literal", views=("v_obs",), oracle="""
SELECT event_id, flight_iata FROM v_obs WHERE contains(lower(flight_iata), 'a1') OR contains(lower('X' || flight_iata), 'a1')
   OR contains(substr(flight_iata, 2), 'a1')""")
def search_mask_literal(spark, sf_dir):
    return search.contains_text(flat(spark, sf_dir), " A1 ").select(
        "event_id", F.col("`flight.iata`").alias("flight_iata")
    )


@query("free_text_search", views=("v_obs",), oracle="""
SELECT event_id FROM v_obs
WHERE len(list_filter([run_id, flight_status, airline_iata, flight_iata, departure_iata, arrival_iata, departure_timezone,
      arrival_timezone], lambda x: regexp_matches(x, 'new.york|ncE$|^landed', 'i'))) > 0""")
def free_text_search(spark, sf_dir):
    rows = table(spark, sf_dir, "v_obs").select(
        "event_id", "run_id", "flight_status", "airline_iata", "flight_iata", "departure_iata",
        "arrival_iata", "departure_timezone", "arrival_timezone",
    )
    return search.any_column_matches(rows, "(?:new.york|ncE$|^landed)").select("event_id")


@query("prediction_labels", views=("v_pred",), oracle="""
SELECT event_id, CASE WHEN delay_probability IS NULL THEN CASE WHEN predicted_is_delayed THEN 'Delayed' ELSE 'On time' END
  WHEN delay_probability >= 0.7 THEN 'High risk of delay' WHEN delay_probability >= 0.4 THEN 'Medium risk of delay'
  ELSE 'Low risk of delay' END AS prediction_label FROM v_pred""")
def prediction_labels(spark, sf_dir):
    return table(spark, sf_dir, "v_pred").select(
        "event_id",
        S.risk_label(F.col("predicted_is_delayed"), F.col("delay_probability")).alias("prediction_label"),
    )


@query("status_messages", views=("v_pred",), oracle="""
WITH shown AS (
  SELECT *, COALESCE(flight_status, 'Not available') AS st,
    CASE WHEN event_id % 3 = 0 THEN CASE WHEN predicted_is_delayed THEN 'Delayed' ELSE 'On time' END END AS lbl,
    COALESCE(departure_delay, 0) AS d, COALESCE(arrival_delay, 0) AS a FROM v_pred)
SELECT event_id, CASE
  WHEN lbl IS NOT NULL AND delay_probability IS NOT NULL THEN 'The flight is currently reported as ''' || st
    || '''. The ML model predicts: ' || lbl || ' with ' || printf('%.1f', delay_probability * 100) || '% delay probability.'
  WHEN lbl IS NOT NULL THEN 'The flight is currently reported as ''' || st || '''. The ML model predicts: ' || lbl || '.'
  WHEN d > 0 OR a > 0 THEN 'The flight has delay information reported. Departure delay: ' || d || ' min. Arrival delay: ' || a || ' min.'
  WHEN st IN ('active', 'scheduled', 'landed') THEN 'The flight status is currently reported as ''' || st || '''.'
  ELSE 'The flight status could not be fully interpreted from the available fields.' END AS message
FROM shown""")
def status_messages(spark, sf_dir):
    rows = table(spark, sf_dir, "v_pred").withColumn(
        "prediction_label",
        F.when(F.col("event_id") % 3 == 0, F.when(F.col("predicted_is_delayed"), "Delayed").otherwise("On time")),
    )
    return rows.select("event_id", explorer.status_message(rows).alias("message"))


@query("selection_labels", views=("v_pred",), oracle="""
SELECT event_id, flight_iata || ' | ' || COALESCE(nullif(departure_iata, ''), '?') || ' → ' || arrival_iata
       || ' | ' || COALESCE(flight_status, 'Not available') AS label FROM v_pred""")
def selection_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "v_pred")
    return rows.select("event_id", explorer.selection_label(rows).alias("label"))


# --- explorer --------------------------------------------------------------------------------


def flat(spark, sf_dir):
    contract = T.StructType([f for f in schemas.FLIGHT_DOCUMENT if f.name != "live"])
    typed = inputs.document_text(spark, sf_dir).select(
        "event_id", F.from_json("text", contract.add("live", T.StructType().add("is_ground", "boolean"))).alias("d")
    )
    return explorer.flat_view(typed.select("event_id", "d.*"))


@query("flat_view", views=("v_obs",), oracle="""
SELECT event_id, CAST(CAST(departure_scheduled AS DATE) AS VARCHAR) AS flight_date, flight_status,
       flight_iata AS "flight.iata", airline_iata AS "airline.iata", departure_iata AS "departure.iata",
       departure_timezone AS "departure.timezone", arrival_iata AS "arrival.iata",
       arrival_delay AS "arrival.delay", live_is_ground AS "live.is_ground" FROM v_obs""")
def flat_view(spark, sf_dir):
    names = [
        "event_id", "flight_date", "flight_status", "flight.iata", "airline.iata", "departure.iata",
        "departure.timezone", "arrival.iata", "arrival.delay", "live.is_ground",
    ]
    return flat(spark, sf_dir).select([search.quoted(n) for n in names])


@query("explorer_kpis", views=("v_obs",), oracle="""
SELECT COUNT(*) AS records, COUNT(*) FILTER (WHERE flight_status = 'active') AS active,
       COUNT(*) FILTER (WHERE regexp_matches(flight_status, 'delay|delayed|late|demorado|atrasado')) AS delayed,
       COUNT(*) FILTER (WHERE flight_status = 'scheduled') AS scheduled FROM v_obs""")
def explorer_kpis(spark, sf_dir):
    return explorer.status_kpis(flat(spark, sf_dir))


@query("explorer_routes", views=("v_obs",), oracle="""
SELECT COALESCE(departure_iata, 'unknown') || ' → ' || COALESCE(arrival_iata, 'unknown') AS route, COUNT(*) AS count
FROM v_obs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def explorer_routes(spark, sf_dir):
    return explorer.top_routes(flat(spark, sf_dir))


@query("explorer_status", views=("v_obs",), oracle="""
SELECT COALESCE(flight_status, 'unknown') AS status, COUNT(*) AS count FROM v_obs GROUP BY 1""")
def explorer_status(spark, sf_dir):
    return explorer.status_distribution(flat(spark, sf_dir))


@query("explorer_filtered", views=("v_obs",), oracle="""
SELECT airline_iata, flight_status, COUNT(*) AS flights FROM v_obs
WHERE flight_status IN ('active', 'landed') AND airline_iata IN ('A1', 'A3') GROUP BY 1, 2""")
def explorer_filtered(spark, sf_dir):
    rows = search.keep_selected(flat(spark, sf_dir), "flight_status", ["active", "landed"])
    rows = search.keep_selected(rows, "airline.iata", ["A1", "A3"])
    return rows.groupBy(search.quoted("airline.iata").alias("airline_iata"), "flight_status").agg(
        F.count(F.lit(1)).alias("flights")
    )
