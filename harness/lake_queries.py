"""Queries over tables the lake keeps beside the data: postings, run index, quarantine, schemas."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from harness import stored
from harness.flight_queries import NEWEST, PRED_COLUMNS, PRED_SELECT, REGION
from harness.registry import query, stamp
from harness.views import table
from skytally.operators.search import quoted
from skytally.plans import explorer, jobs, quarantine, runlog, serving
from skytally.schemas import ROUTES
from skytally.sources.table_schemas import stored_schema
from skytally.sources.tables import read_table

# --- substring search by postings ------------------------------------------------------------


@query("search_trigram", views=("v_pred",), oracle=f"""
{PRED_SELECT} FROM v_pred WHERE flight_iata ILIKE '%xa1_%' OR flight_icao ILIKE '%xa1_%' {NEWEST} LIMIT 50""")
def search_trigram(spark, sf_dir):
    rows, index = stored.searchable_predictions(spark, sf_dir)
    return serving.search_flights(rows, " Xa1_ ", 50, ties=("event_id",), index=index).select(PRED_COLUMNS)


@query("search_trigram_literal", views=("v_pred",), oracle="""
SELECT event_id, flight_iata, flight_icao FROM v_pred WHERE contains(lower(flight_iata), 'a12') OR contains(lower(flight_icao), 'a12')""")
def search_trigram_literal(spark, sf_dir):
    rows, index = stored.searchable_predictions(spark, sf_dir)
    # The literal search looks at columns of these names.
    named = rows.withColumnsRenamed({"flight_iata": "flight.iata", "flight_icao": "flight.icao"})
    index = stored.TrigramIndex(index.path, ("flight.iata", "flight.icao"), index.key, index.part)
    hits = index.contains_text(named, " A12 ").withColumnsRenamed({"flight.iata": "flight_iata", "flight.icao": "flight_icao"})
    return hits.select("event_id", "flight_iata", "flight_icao")


# --- latest run by the run index ---------------------------------------------------------------
# The runs of odd days were loaded last.

LAST_LOADED = "run_id = (SELECT max(run_id) FROM v_obs WHERE CAST(right(run_id, 2) AS INT) % 2 = 1)"


@query("run_index", views=("v_obs",), oracle="""
SELECT run_id, run_id AS run_day, CAST(CAST(right(run_id, 2) AS INT) % 2 AS BIGINT) AS loaded_seq, COUNT(*) AS routes,
       'flights_' || run_id || '_' || max(strftime(departure_scheduled, '%H')) AS file_name FROM v_obs GROUP BY 1""")
def run_index(spark, sf_dir):
    runs = jobs.read_runs(spark, stored.route_lake(spark, sf_dir))
    return runs.select("run_id", "run_day", "loaded_seq", "routes", "file_name")


@query("latest_route_count_indexed", views=("v_obs",), oracle=f"SELECT COUNT(*) AS total_routes FROM v_obs WHERE {LAST_LOADED}")
def latest_route_count_indexed(spark, sf_dir):
    return jobs.route_dashboard(spark, stored.route_lake(spark, sf_dir))["total_routes"]


@query("region_flows_indexed", views=("v_obs",), oracle=f"""
SELECT {REGION.format(c='departure_timezone')} || ' → ' || {REGION.format(c='arrival_timezone')} AS route_region,
       COUNT(*) AS flights
FROM v_obs WHERE {LAST_LOADED} AND departure_timezone IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def region_flows_indexed(spark, sf_dir):
    return jobs.route_dashboard(spark, stored.route_lake(spark, sf_dir))["region_flows"]


@query("latest_routes_indexed", views=("v_obs",), oracle=f"""
SELECT CAST(CAST(departure_scheduled AS DATE) AS VARCHAR) AS flight_date, run_id,
       CAST(NULL AS VARCHAR) AS aircraft_icao24, airline_iata, flight_iata, nullif(departure_iata, '') AS departure_iata,
       {REGION.format(c='departure_timezone')} AS departure_region, arrival_iata,
       {REGION.format(c='arrival_timezone')} AS arrival_region, flight_status
FROM v_obs WHERE {LAST_LOADED}
ORDER BY date_trunc('second', departure_scheduled) NULLS LAST, flight_iata NULLS LAST, event_id LIMIT 100""")
def latest_routes_indexed(spark, sf_dir):
    return jobs.route_dashboard(spark, stored.route_lake(spark, sf_dir))["latest_routes"]


# --- flat view of stored documents -------------------------------------------------------------
# Key and day of a document agree, so each is loaded in one of the two loads; within it the last file counts.

PLACE = "(run_id, strftime(departure_scheduled, '%H'), event_id)"
FLAT_FIELDS = {
    "flight_date": "any_value(CAST(CAST(departure_scheduled AS DATE) AS VARCHAR))",
    "flight_status": f"arg_max(flight_status, {PLACE}) FILTER (WHERE flight_status IS NOT NULL)",
    "flight.iata": "any_value(flight_iata)", "flight.number": "any_value(substr(flight_iata, 2))",
    "airline.iata": "any_value(airline_iata)",
    "departure.iata": "any_value(departure_iata)", "departure.icao": f"arg_max(departure_icao, {PLACE})",
    "departure.delay": f"arg_max(struct_pack(d := CAST(departure_delay AS VARCHAR)), {PLACE}).d",
    "arrival.iata": "any_value(arrival_iata)",
    "arrival.delay": f"arg_max(struct_pack(d := arrival_delay), {PLACE}).d",
    "arrival.timezone": f"arg_max(arrival_timezone, {PLACE})",
    "live.is_ground": f"arg_max(live_is_ground, {PLACE}) FILTER (WHERE live_is_ground IS NOT NULL)",
    "_meta.run_id": "any_value(CASE WHEN CAST(right(run_id, 2) AS INT) % 2 = 1 THEN 'odd' ELSE 'even' END)",
}


@query("flat_view_documents", views=("v_obs",), oracle="SELECT " + ", ".join(
    f'{sql} AS "{name}"' for name, sql in FLAT_FIELDS.items()) + """
FROM v_obs GROUP BY CAST(departure_scheduled AS DATE), flight_iata, departure_iata, arrival_iata, airline_iata""")
def flat_view_documents(spark, sf_dir):
    documents = jobs.read_documents(spark, stored.document_lake(spark, sf_dir), "flights")
    return explorer.stored_documents(documents).select([quoted(n) for n in FLAT_FIELDS])


# --- quarantine ----------------------------------------------------------------------------------
# What the seven payload shapes hold beside valid records; every thirteenth file is cut short.

SET_ASIDE_SQL = """
WITH kinds AS (SELECT * FROM (VALUES
  (1, 1, 'not_an_object', '"junk"'), (2, 2, 'not_an_object', '5'), (4, NULL, 'no_record_list', '"invalid"'),
  (5, 0, 'invalid_key', '{}'), (6, 0, 'invalid_key', NULL), (6, 1, 'invalid_key', NULL), (6, 3, 'not_an_object', '7')
  ) AS k (shape, record_ix, reason, content)),
aside AS (
  SELECT 'f' || event_id AS file_name, CAST(record_ix AS BIGINT) AS record_ix, reason, content
  FROM v_obs JOIN kinds ON shape = event_id % 7 WHERE event_id % 13 <> 0
  UNION ALL SELECT 'f' || event_id, NULL, 'bad_json', NULL FROM v_obs WHERE event_id % 13 = 0)
"""


def set_aside(spark, sf_dir):
    return quarantine.quarantined(spark, stored.poisoned_lake(spark, sf_dir).path("quarantine"))


@query("quarantine_rows", views=("v_obs",), oracle=SET_ASIDE_SQL + "SELECT * FROM aside")
def quarantine_rows(spark, sf_dir):
    short = F.when(~F.col("content").startswith("[") & (F.length("content") < 12) & (F.col("reason") != "bad_json"), F.col("content"))
    return set_aside(spark, sf_dir).select("file_name", "record_ix", "reason", short.alias("content"))


@query("quarantine_reasons", views=("v_obs",), oracle=SET_ASIDE_SQL + """
SELECT 'flights' AS endpoint, reason, COUNT(*) AS rows, COUNT(DISTINCT file_name) AS files FROM aside GROUP BY reason""")
def quarantine_reasons(spark, sf_dir):
    return quarantine.reasons(set_aside(spark, sf_dir))


@query("poisoned_documents", views=("v_obs",), oracle="""
SELECT COUNT(DISTINCT (CAST(departure_scheduled AS DATE), flight_iata, departure_iata, arrival_iata, airline_iata)) AS documents
FROM v_obs WHERE event_id % 13 <> 0 AND event_id % 7 NOT IN (4, 5)""")
def poisoned_documents(spark, sf_dir):
    documents = jobs.read_documents(spark, stored.poisoned_lake(spark, sf_dir), "flights")
    return documents.agg(F.count(F.lit(1)).alias("documents"))


# --- stored schemas ------------------------------------------------------------------------------


@query("schema_evolution", views=("v_obs",), oracle="""
SELECT event_id, run_id, flight_iata, CAST(departure_delay AS BIGINT) AS departure_delay,
       CASE WHEN CAST(right(run_id, 2) AS INT) % 2 = 1 THEN arrival_delay END AS arrival_delay FROM v_obs""")
def schema_evolution(spark, sf_dir):
    return read_table(spark, stored.evolved_table(spark, sf_dir))


@query("evolved_columns", views=("v_obs",), oracle="""
SELECT * FROM (VALUES ('event_id', 'bigint'), ('flight_iata', 'string'), ('departure_delay', 'bigint'), ('run_id', 'string'),
  ('arrival_delay', 'int')) AS c (name, type) WHERE EXISTS (SELECT * FROM v_obs)""")
def evolved_columns(spark, sf_dir):
    schema = stored_schema(spark, stored.evolved_table(spark, sf_dir))
    columns = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in schema])
    rows = read_table(spark, stored.evolved_table(spark, sf_dir))
    return rows.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.inline(columns))


# --- run metrics over a time range ----------------------------------------------------------------

SERIES = runlog.TimeRange(datetime(2024, 1, 5), datetime(2024, 1, 12, 1), 6 * 3600)
GRID = "grid AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-12 01:00', INTERVAL 6 HOUR)) AS t)"


@query("run_metric_series", views=("v_runs",), oracle=f"""
WITH {GRID}
SELECT {stamp('t')} AS "at", source, endpoint, stage,
       CAST(arg_max(struct_pack(v := status = 'success'), (finished_at, run_id)).v AS BIGINT) AS status_value,
       round(arg_max(struct_pack(v := duration_seconds), (finished_at, run_id)).v, 6) AS duration_seconds,
       arg_max(struct_pack(v := records_processed), (finished_at, run_id)).v AS records_processed
FROM grid JOIN v_runs ON finished_at <= t GROUP BY t, source, endpoint, stage""")
def run_metric_series(spark, sf_dir):
    return runlog.metric_series(table(spark, sf_dir, "v_runs"), SERIES)


@query("executions_by_step", views=("v_runs",), oracle=f"""
WITH {GRID},
held AS (SELECT * FROM v_runs WHERE finished_at > TIMESTAMP '2024-01-05' AND finished_at <= (SELECT max(t) FROM grid)),
groups AS (SELECT DISTINCT endpoint, stage, status FROM held)
SELECT {stamp('t')} AS "at", g.endpoint, g.stage, g.status, COUNT(h.run_id) AS executions
FROM grid CROSS JOIN groups g LEFT JOIN held h ON h.endpoint = g.endpoint AND h.stage = g.stage AND h.status = g.status
     AND h.finished_at > t - INTERVAL 6 HOUR AND h.finished_at <= t
WHERE t > TIMESTAMP '2024-01-05' GROUP BY t, g.endpoint, g.stage, g.status""")
def executions_by_step(spark, sf_dir):
    return runlog.executions_by_step(table(spark, sf_dir, "v_runs"), SERIES)


@query("run_range_gauges", views=("v_runs",), oracle="""
SELECT endpoint, arg_max(CAST(status = 'success' AS BIGINT), (finished_at, run_id)) AS last_status,
       round(arg_max(duration_seconds, (finished_at, run_id)), 6) AS last_duration_seconds,
       arg_max(records_processed, (finished_at, run_id)) AS last_records_processed,
       MAX(CAST(status = 'success' AS BIGINT)) AS max_status, round(MAX(duration_seconds), 6) AS max_duration_seconds,
       MAX(records_processed) AS max_records_processed
FROM v_runs WHERE finished_at BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12 01:00' GROUP BY 1""")
def run_range_gauges(spark, sf_dir):
    return runlog.gauges(runlog.in_range(table(spark, sf_dir, "v_runs"), SERIES), ["endpoint"])


# --- run log upkeep -------------------------------------------------------------------------------


@query("run_log_compacted", views=("v_runs",), oracle=f"""
SELECT CAST(run_id AS VARCHAR) AS run_id, source, endpoint, stage, status, {stamp('finished_at')} AS finished_at,
       round(duration_seconds, 6) AS duration_seconds, records_processed
FROM v_runs WHERE NOT (source = 'aviationstack' AND endpoint = 'airports' AND stage = 'load_signup')""")
def run_log_compacted(spark, sf_dir):
    return runlog.read_runs(spark, stored.kept_log(spark, sf_dir))


@query("run_log_files", views=("v_runs",), oracle=f"""
SELECT endpoint, stage, COUNT(DISTINCT CAST(finished_at AS DATE)) AS files, COUNT(*) AS runs
FROM v_runs WHERE stage <> 'load_signup' AND finished_at < TIMESTAMP '{stored.COMPACTED_BEFORE}' GROUP BY 1, 2""")
def run_log_files(spark, sf_dir):
    rows = runlog.read_runs(spark, stored.kept_log(spark, sf_dir))
    closed = rows.where(F.col("finished_at") < stored.COMPACTED_BEFORE)
    return closed.groupBy("endpoint", "stage").agg(
        F.count_distinct("_metadata.file_path").alias("files"), F.count(F.lit(1)).alias("runs"))


# --- payloads that land again ----------------------------------------------------------------------

CONTENT = """CAST(date_trunc('second', departure_scheduled) AS VARCHAR), flight_status, flight_iata, airline_iata, departure_iata,
  departure_icao, departure_timezone, event_id % 6 = 2 AND departure_delay IS NOT NULL, departure_delay, arrival_iata, arrival_timezone,
  arrival_delay, live_is_ground"""


@query("stream_replayed_payloads", views=("v_obs",), oracle=f"""
SELECT run_id, COUNT(*) AS routes FROM (SELECT DISTINCT run_id, {CONTENT} FROM v_obs) GROUP BY 1""")
def stream_replayed_payloads(spark, sf_dir):
    """Every payload lands under two names, and is loaded once."""
    lake = stored.replayed_lake(spark, sf_dir)
    routes = read_table(spark, lake.path("flight_aircraft_routes"), ROUTES)
    return routes.groupBy("run_id").agg(F.count(F.lit(1)).alias("routes"))
