"""Queries over files as they land, and the tables that are loaded from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness import landed, stored
from harness.registry import query, stamp
from harness.state_queries import training_rows
from harness.views import table
from skytally.functions import records as R
from skytally.operators import sampling
from skytally.plans import jobs
from skytally.schemas import PREDICTIONS
from skytally.session import scratch_path
from skytally.sources import csv_files, payloads, tables

# --- payload files -------------------------------------------------------------------------------


def records_by_file(files):
    records = R.unwrap(payloads.parse_payloads(files), "flights")
    return records.groupBy("file_name", "source", "endpoint", "run_id").agg(F.count(F.lit(1)).alias("records"))


@query("raw_files", views=("v_obs",), oracle="""
SELECT 'aviationstack_flights_incoming_' || run_id || '.json' AS file_name, 'aviationstack' AS source, 'flights' AS endpoint,
       run_id, COUNT(*) AS records FROM v_obs GROUP BY run_id""")
def raw_files(spark, sf_dir):
    raw = payloads.scan_raw(spark, landed.payload_files(spark, sf_dir)["raw"], " AviationStack", "flights")
    return records_by_file(payloads.promote_to_incoming(raw))


@query("incoming_discovery", views=("v_obs",), oracle="""
SELECT asked, fallback, run_id, COUNT(*) AS records
FROM v_obs, (VALUES ('20240103', FALSE), ('20240115', TRUE)) AS a (asked, fallback)
WHERE CASE WHEN fallback THEN CAST(right(run_id, 2) AS INT) <= 10 ELSE run_id = asked END GROUP BY ALL""")
def incoming_discovery(spark, sf_dir):
    """A run that has landed is found by its name; for another, whatever has landed is taken."""
    folder, found = landed.payload_files(spark, sf_dir)["incoming"], []
    for asked in ("20240103", "20240115"):
        files, fallback = payloads.discover_incoming(spark, folder, "aviationstack", "flights", asked)
        found.append(records_by_file(files).select(
            F.lit(asked).alias("asked"), F.lit(fallback).alias("fallback"), "run_id", "records"))
    return found[0].unionByName(found[1])


@query("snapshot_files", views=("v_obs",), oracle="""
SELECT run_id, CASE WHEN right(run_id, 2) > '20' THEN 'r7__' ELSE '' END || 'aviationstack_flights_incoming_' || run_id || '.json' AS file_name,
       COUNT(*) AS records FROM v_obs WHERE run_id IN ('20240104', '20240112', '20240123') GROUP BY run_id""")
def snapshot_files(spark, sf_dir):
    places, found = landed.payload_files(spark, sf_dir), None
    for run_id in ("20240104", "20240112", "20240123"):
        files = payloads.find_snapshot_files(
            spark, places["incoming"], places["processed"], "aviationstack", "flights", run_id)
        records = R.unwrap(payloads.parse_payloads(files), "insights").groupBy("file_name").agg(F.count(F.lit(1)).alias("records"))
        rows = records.select(F.lit(run_id).alias("run_id"), "file_name", "records")
        found = rows if found is None else found.unionByName(rows)
    return found


# --- flight and point CSVs -------------------------------------------------------------------------


@query("history_files", views=("v_hist",), oracle="""
SELECT origin AS "ADEP", COUNT(*) AS flights, COUNT(DISTINCT operator) AS operators,
       CAST(SUM(CASE WHEN delay_minutes IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unknown, round(SUM(CAST(requested_fl AS DOUBLE)), 6) AS levels
FROM v_hist GROUP BY origin""")
def history_files(spark, sf_dir):
    rows, _ = csv_files.scan_history(spark, landed.flight_files(spark, sf_dir), ["ADES"])
    origin = F.regexp_extract("source_file", r"Flights_([^_]*)_", 1)
    return rows.groupBy(origin.alias("ADEP")).agg(
        F.count(F.lit(1)).alias("flights"), F.count_distinct("AC Operator").alias("operators"),
        F.count_if(F.coalesce("departure_delay_min", F.lit("")) == "").alias("unknown"),
        F.sum(F.col("`Requested FL`").cast("double")).alias("levels"))


@query("point_files", views=("v_points",), oracle="""
SELECT flight_id AS "ECTRL ID", sequence_number AS "Sequence Number", round(latitude, 6) AS "Latitude", round(longitude, 6) AS "Longitude"
FROM v_points""")
def point_files(spark, sf_dir):
    return csv_files.scan_points(spark, landed.point_files(spark, sf_dir))


# --- reference data and predictions ------------------------------------------------------------------


def loaded_reference(spark, sf_dir, kind):
    def build():
        lake = jobs.Lake(scratch_path(spark, "lake"))
        files = landed.reference_payloads(spark, sf_dir, kind)
        for run, part in (("even", ~stored.odd_day()), ("odd", stored.odd_day())):
            jobs.load_documents(spark, lake, files.where(part), f"{kind}s", "aviationstack", run)
        return lake

    rows = jobs.read_documents(spark, stored.once(f"{kind}s", spark, sf_dir, build), f"{kind}s")
    at = lambda c, kind: F.try_variant_get(c, F.lit("$"), kind)
    return rows.select(*R.KEY_RULES[f"{kind}s"][1], at("seen", "bigint").alias("seen"), at("note", "string").alias("note"))


REFERENCE_SQL = """
SELECT {key}, arg_max(event_id, (odd, run_id, event_id)) AS seen,
       arg_max(flight_status, (odd, run_id, event_id)) FILTER (WHERE event_id % 3 = 0 AND flight_status IS NOT NULL) AS note
FROM (SELECT *, CAST(right(run_id, 2) AS INT) % 2 AS odd FROM v_obs) {where} GROUP BY {group}"""


@query("stored_airlines", views=("v_obs",), oracle=REFERENCE_SQL.format(
    key="airline_iata, 'Y' || airline_iata AS airline_icao, 'Name ' || airline_iata AS airline_name",
    where="WHERE airline_iata IS NOT NULL", group="airline_iata"))
def stored_airlines(spark, sf_dir):
    return loaded_reference(spark, sf_dir, "airline")


@query("stored_airports", views=("v_obs",), oracle=REFERENCE_SQL.format(
    key="nullif(departure_iata, '') AS airport_iata, 'Y' || departure_icao AS airport_icao, 'Name ' || departure_iata AS airport_name",
    where="", group="departure_iata, departure_icao"))
def stored_airports(spark, sf_dir):
    return loaded_reference(spark, sf_dir, "airport")


@query("stored_predictions", views=("v_pred",), oracle=f"""
WITH keyed AS (SELECT *, date_trunc('day', departure_scheduled) AS day, event_id % 2 AS load FROM v_pred)
SELECT flight_iata, {stamp('day')} AS departure_scheduled, round(arg_max(COALESCE(delay_probability, -1), (load, COALESCE(delay_probability, -1))), 6) AS delay_probability
FROM keyed GROUP BY flight_iata, day""")
def stored_predictions(spark, sf_dir):
    """Two loads of scored flights; the later one replaces rows of its keys."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    rows = table(spark, sf_dir, "v_pred", spread=True)
    day = F.date_trunc("day", F.col("departure_scheduled").cast("timestamp"))
    served = rows.withColumns({
        "flight_number": F.substring("flight_iata", 2, 20), "flight_date": day.cast("date"), "departure_scheduled": day,
        "delay_probability": F.coalesce("delay_probability", F.lit(-1.0))})
    for load in range(2):
        jobs.store_predictions(spark, lake, tables.conform(served.where(F.col("event_id") % 2 == load), PREDICTIONS))
    kept = tables.read_table(spark, lake.path("flight_predictions"), PREDICTIONS)
    return kept.select("flight_iata", "departure_scheduled", "delay_probability")


@query("bernoulli_share", views=("v_hist",), oracle="""
SELECT TRUE AS share_as_asked, TRUE AS same_rows_again, COUNT(*) AS rows FROM v_hist WHERE origin LIKE 'LF%' AND destination LIKE 'LF%'""")
def bernoulli_share(spark, sf_dir):
    """The sampled share is within six standard deviations of the asked one, and a seed picks the same rows."""
    rows = training_rows(spark, sf_dir)
    one, two = (sampling.bernoulli_sample(rows, 0.2, 7).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*rows.columns) % 1_000_003).alias("h")) for _ in range(2))
    counted = rows.agg(F.count(F.lit(1)).alias("rows"))
    marked = one.select("n", "h", F.lit(0).cast("long").alias("rows")).unionByName(two.select("n", "h", F.lit(0).cast("long").alias("rows"))).unionByName(
        counted.select(F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("h"), "rows"))
    total, n = F.max("rows"), F.max("n")
    return marked.agg(
        (F.abs(n - 0.2 * total) <= 6 * F.sqrt(0.16 * total)).alias("share_as_asked"),
        ((F.min("n") == n) & (F.min("h").eqNullSafe(F.max("h")))).alias("same_rows_again"), total.alias("rows"))
