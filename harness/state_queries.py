"""Merge, sampling, model, run-log and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness import inputs
from harness.bi_queries import LATE
from harness.flight_queries import SNAPSHOT_SQL
from harness.registry import query, stamp
from harness.views import table
from skytally import schemas
from skytally.functions import records as R
from skytally.operators import merge, sampling
from skytally.plans import features, model, runlog
from skytally.plans.jobs import Lake
from skytally.session import scratch_path
from skytally.sources.tables import as_documents, read_table, scan_recent
from skytally.streaming.snapshots import ingest

# --- merges ----------------------------------------------------------------------------------
# The stored side is what the first half of the month loaded, the batch is the second half.

MIDDLE = "2024-01-16"

MONTHLY_DOCUMENT = """to_json(named_struct(
  'flight_date', CAST(CAST(date_trunc('MONTH', departure_scheduled) AS DATE) AS STRING),
  'flight_status', flight_status,
  'flight', named_struct('iata', flight_iata),
  'airline', named_struct('iata', airline_iata),
  'departure', named_struct('iata', departure_iata, 'delay', departure_delay),
  'arrival', named_struct('iata', arrival_iata),
  'live', CASE WHEN live_is_ground IS NOT NULL THEN named_struct('is_ground', live_is_ground) END))"""

DOC_KEYS = "flight_date, flight_number, departure_iata, arrival_iata, airline_iata"
DOC_STATE = """{k}, COUNT(*) AS n,
  arg_max(flight_status, event_id) FILTER (WHERE flight_status IS NOT NULL) AS flight_status,
  arg_max(live_is_ground, event_id) FILTER (WHERE live_is_ground IS NOT NULL) AS live_is_ground,
  arg_max(struct_pack(d := departure_delay), event_id) AS departure"""


def half(first: bool) -> str:
    return f"departure_scheduled {'<' if first else '>='} TIMESTAMP '{MIDDLE}'"


MERGE_SQL = f"""
WITH keyed AS (
  SELECT *, CAST(CAST(date_trunc('month', departure_scheduled) AS DATE) AS VARCHAR) AS flight_date, flight_iata AS flight_number
  FROM v_obs),
whole AS (SELECT {DOC_STATE.format(k=DOC_KEYS)} FROM keyed GROUP BY {DOC_KEYS}),
old AS (SELECT {DOC_STATE.format(k=DOC_KEYS)} FROM keyed WHERE {half(True)} GROUP BY {DOC_KEYS}),
fresh AS (SELECT {DOC_KEYS}, COUNT(*) AS n FROM keyed WHERE {half(False)} GROUP BY {DOC_KEYS}),
merged AS (
  SELECT w.*, COALESCE(f.n, 0) AS batch_rows,
    CASE WHEN f.n IS NULL THEN 'kept' WHEN o.n IS NULL THEN 'inserted'
         WHEN o.flight_status IS NOT DISTINCT FROM w.flight_status AND o.live_is_ground IS NOT DISTINCT FROM w.live_is_ground
              AND o.departure.d IS NOT DISTINCT FROM w.departure.d THEN 'unchanged' ELSE 'updated' END AS change_type
  FROM whole w
  LEFT JOIN old o ON o.flight_date = w.flight_date AND o.flight_number = w.flight_number AND o.departure_iata = w.departure_iata
    AND o.arrival_iata = w.arrival_iata AND o.airline_iata IS NOT DISTINCT FROM w.airline_iata
  LEFT JOIN fresh f ON f.flight_date = w.flight_date AND f.flight_number = w.flight_number AND f.departure_iata = w.departure_iata
    AND f.arrival_iata = w.arrival_iata AND f.airline_iata IS NOT DISTINCT FROM w.airline_iata)
"""


def merged_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "v_obs", spread=True).withColumn("doc", F.expr(MONTHLY_DOCUMENT))
    payload = F.parse_json(F.concat(F.lit("["), "doc", F.lit("]")))
    records = R.unwrap(
        rows.select("event_id", "departure_scheduled", payload.alias("payload")), "flights"
    )
    keyed = R.with_keys(records, "flights").where("is_valid")
    fields = [f for f in merge.top_level_fields(keyed) if f not in R.FLIGHT_KEY]
    spread = merge.spread_fields(keyed.select("*").drop("is_valid", "record_ix"), fields)
    cut = F.lit(MIDDLE).cast("timestamp_ntz")
    before, after = (
        spread.where(c).drop("departure_scheduled")
        for c in (F.col("departure_scheduled") < cut, F.col("departure_scheduled") >= cut)
    )
    stored = merge.merge_documents(None, before, R.FLIGHT_KEY, ["event_id"])
    return merge.merge_documents(
        stored.drop("change_type", "batch_rows"), after, R.FLIGHT_KEY, ["event_id"]
    )


@query("merge_documents", views=("v_obs",), oracle=MERGE_SQL + f"""
SELECT {DOC_KEYS}, flight_status, live_is_ground, departure.d AS departure_delay, batch_rows, change_type FROM merged""")
def merge_documents(spark, sf_dir):
    at = lambda c, path, kind: F.try_variant_get(c, F.lit(path), kind)
    return merged_documents(spark, sf_dir).select(
        *R.FLIGHT_KEY, at("flight_status", "$", "string").alias("flight_status"),
        at("live", "$.is_ground", "boolean").alias("live_is_ground"),
        at("departure", "$.delay", "int").alias("departure_delay"), "batch_rows", "change_type",
    )


@query("merge_counters", views=("v_obs",), oracle=MERGE_SQL + """
SELECT CAST(SUM(batch_rows) AS BIGINT) AS valid, COUNT(*) FILTER (WHERE change_type = 'inserted') AS inserted,
       COUNT(*) FILTER (WHERE change_type = 'updated') AS updated, COUNT(*) FILTER (WHERE change_type = 'unchanged') AS unchanged,
       CAST(SUM(batch_rows) - COUNT(*) FILTER (WHERE batch_rows > 0) AS BIGINT) AS folded FROM merged""")
def merge_counters(spark, sf_dir):
    return merge.change_counters(merged_documents(spark, sf_dir))


@query("loader_counters", views=("v_obs",), oracle="""
SELECT run_id AS file_name, CAST(SUM(CASE event_id % 7 WHEN 4 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 6 THEN 4 ELSE 1 END) AS BIGINT) AS records,
       CAST(SUM(CASE event_id % 7 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 6 THEN 1 ELSE 0 END) AS BIGINT) AS valid,
       CAST(SUM(CASE event_id % 7 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 5 THEN 1 WHEN 6 THEN 3 ELSE 0 END) AS BIGINT) AS invalid
FROM v_obs GROUP BY run_id""")
def loader_counters(spark, sf_dir):
    files = inputs.payloads(spark, sf_dir).withColumn("file_name", F.col("run_id"))
    return merge.record_counters(R.with_keys(R.unwrap(files, "flights"), "flights")).where("records > 0")


REL_KEYS = ["flight_iata", "departure_iata", "arrival_iata", "airline_iata"]
_REL = ", ".join(REL_KEYS)


@query("merge_relational", views=("v_obs",), oracle=f"""
SELECT {_REL}, arg_max(event_id, event_id) AS event_id, arg_max(struct_pack(s := flight_status), event_id).s AS flight_status,
       {stamp('arg_min(departure_scheduled, event_id)')} AS created_at
FROM v_obs WHERE airline_iata IS NOT NULL GROUP BY {_REL}
UNION ALL
SELECT {_REL}, event_id, flight_status, {stamp('departure_scheduled')} FROM v_obs WHERE airline_iata IS NULL""")
def merge_relational(spark, sf_dir):
    rows = table(spark, sf_dir, "v_obs").select(
        *REL_KEYS, "event_id", "flight_status", F.col("departure_scheduled").alias("created_at")
    )
    middle = rows.agg(F.max("event_id")).scalar() / 2
    empty = spark.createDataFrame([], rows.schema)
    stored = merge.merge_relational(empty, rows.where(F.col("event_id") <= middle), REL_KEYS, ["event_id"])
    return merge.merge_relational(stored, rows.where(F.col("event_id") > middle), REL_KEYS, ["event_id"])


# --- sampling --------------------------------------------------------------------------------


def training_rows(spark, sf_dir):
    return model.coerce_training(features.history_features(inputs.history_text(spark, sf_dir), True))


CLASSES = f"""classes AS (
  SELECT CAST(COALESCE({LATE}, FALSE) AS BIGINT) AS is_delayed, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS total
  FROM v_hist WHERE origin LIKE 'LF%' AND destination LIKE 'LF%' GROUP BY 1)"""


@query("stratified_sample_counts", views=("v_hist",), oracle=f"""
WITH {CLASSES}
SELECT is_delayed, CAST(CASE WHEN total <= 10000 THEN n ELSE least(n, greatest(1, (10000 * n) // total)) END AS BIGINT) AS picked FROM classes""")
def stratified_sample_counts(spark, sf_dir):
    sample = model.prepare_training(training_rows(spark, sf_dir), max_rows=10_000)
    return sample.groupBy(schemas.TARGET).agg(F.count(F.lit(1)).alias("picked"))


@query("stratified_split_counts", views=("v_hist",), oracle=f"""
WITH {CLASSES}, exact AS (SELECT *, ceil(total * 0.2) AS wanted, ceil(total * 0.2) * n / total AS share FROM classes),
floors AS (SELECT *, floor(share) AS base, wanted - SUM(floor(share)) OVER () AS short,
                  row_number() OVER (ORDER BY floor(share) - share, CAST(is_delayed AS VARCHAR)) AS rn FROM exact)
SELECT is_delayed, CAST(base + CASE WHEN rn <= short THEN 1 ELSE 0 END AS BIGINT) AS held_out,
       CAST(n - base - CASE WHEN rn <= short THEN 1 ELSE 0 END AS BIGINT) AS training FROM floors""")
def stratified_split_counts(spark, sf_dir):
    rows = model.prepare_training(training_rows(spark, sf_dir), max_rows=0)
    training, held_out = sampling.split_train_test(rows, schemas.TARGET)
    marked = training.select(schemas.TARGET, F.lit(1).alias("t")).unionByName(
        held_out.select(schemas.TARGET, F.lit(0).alias("t"))
    )
    return marked.groupBy(schemas.TARGET).agg(
        F.count_if(F.col("t") == 0).alias("held_out"), F.count_if(F.col("t") == 1).alias("training")
    )


@query("bernoulli_sample")
def bernoulli_sample(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    return sampling.bernoulli_sample(rows).agg(F.count(F.lit(1)).alias("sampled"))


# --- model -----------------------------------------------------------------------------------


@query("confusion_report", views=("v_pred",), oracle="""
WITH c AS (
  SELECT COUNT(*) FILTER (WHERE NOT y AND NOT p) AS tn, COUNT(*) FILTER (WHERE NOT y AND p) AS fp,
         COUNT(*) FILTER (WHERE y AND NOT p) AS fn, COUNT(*) FILTER (WHERE y AND p) AS tp
  FROM (SELECT COALESCE(departure_delay > 15, FALSE) AS y, predicted_is_delayed AS p FROM v_pred)),
m AS (SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2.0 * tn / (2 * tn + fn + fp) AS f0,
             tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2.0 * tp / (2 * tp + fp + fn) AS f1,
             tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS s FROM c)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support, tn, fp, fn, tp FROM (
  SELECT 'on_time' AS label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support, tn, fp, fn, tp FROM m
  UNION ALL SELECT 'delayed', p1, r1, f1, s1, tn, fp, fn, tp FROM m
  UNION ALL SELECT 'accuracy', (tn + tp) / s, (tn + tp) / s, (tn + tp) / s, s, tn, fp, fn, tp FROM m
  UNION ALL SELECT 'macro', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s, tn, fp, fn, tp FROM m
  UNION ALL SELECT 'weighted', (p0 * s0 + p1 * s1) / s, (r0 * s0 + r1 * s1) / s, (f0 * s0 + f1 * s1) / s, s, tn, fp, fn, tp FROM m)""")
def confusion_report(spark, sf_dir):
    rows = table(spark, sf_dir, "v_pred").select(
        F.coalesce(F.col("departure_delay") > 15, F.lit(False)).alias("late"), "predicted_is_delayed"
    )
    return model.confusion_report(rows, "late", "predicted_is_delayed")


@query("train_score_forest")
def train_score_forest(spark, sf_dir):
    dataset = model.prepare_training(training_rows(spark, sf_dir), max_rows=0)
    return model.train_and_evaluate(dataset, "forest_job")[1]


@query("train_score_boosting")
def train_score_boosting(spark, sf_dir):
    dataset = model.prepare_training(training_rows(spark, sf_dir), max_rows=0)
    return model.train_and_evaluate(dataset, "boosting_notebook")[1]


# --- run log ---------------------------------------------------------------------------------


@query("run_log_gauges", views=("v_runs",), oracle="""
SELECT source, endpoint, stage, arg_max(CAST(status = 'success' AS BIGINT), (finished_at, run_id)) AS last_status,
       round(arg_max(duration_seconds, (finished_at, run_id)), 6) AS last_duration_seconds,
       arg_max(records_processed, (finished_at, run_id)) AS last_records_processed,
       MAX(CAST(status = 'success' AS BIGINT)) AS max_status, round(MAX(duration_seconds), 6) AS max_duration_seconds,
       MAX(records_processed) AS max_records_processed
FROM v_runs WHERE regexp_full_match(endpoint, 'flights|air.*') GROUP BY 1, 2, 3""")
def run_log_gauges(spark, sf_dir):
    runs = runlog.selected(table(spark, sf_dir, "v_runs"), source=".*", endpoint="flights|air.*", stage=".*")
    return runlog.gauges(runs)


@query("total_executions", views=("v_runs",), oracle="""
SELECT COUNT(*) AS executions FROM v_runs WHERE endpoint = 'flights'""")
def total_executions(spark, sf_dir):
    return runlog.total_executions(runlog.selected(table(spark, sf_dir, "v_runs"), endpoint="flights"))


@query("failure_rate", views=("v_runs",), oracle="""
SELECT round(100.0 * COUNT(*) FILTER (WHERE status = 'failed') / greatest(COUNT(*), 1), 6) AS failure_rate FROM v_runs""")
def failure_rate(spark, sf_dir):
    return runlog.failure_rate(table(spark, sf_dir, "v_runs"))


@query("runs_by_status", views=("v_runs",), oracle="""
SELECT endpoint, stage, status, COUNT(*) AS executions FROM v_runs GROUP BY 1, 2, 3""")
def runs_by_status(spark, sf_dir):
    return runlog.executions_by_status(table(spark, sf_dir, "v_runs"))


@query("run_label_values", views=("v_runs",), oracle="SELECT DISTINCT stage FROM v_runs")
def run_label_values(spark, sf_dir):
    return runlog.label_values(table(spark, sf_dir, "v_runs"), "stage")


@query("run_event_lines", views=("v_runs",), oracle="""
SELECT '{"run_id":' || run_id || ',"stage":"' || stage || '","status":"' || status || '"}' AS value FROM v_runs""")
def run_event_lines(spark, sf_dir):
    return runlog.event_lines(table(spark, sf_dir, "v_runs").select("run_id", "stage", "status"))


# --- streaming -------------------------------------------------------------------------------


def streamed_lake(spark, sf_dir) -> Lake:
    """Every event through the streaming ingest, one payload per event, one file per run."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    stream.createOrReplaceTempView("streamed_events")
    from harness.views import VIEWS

    observed = spark.sql(VIEWS["v_obs"].replace("FROM events", "FROM streamed_events"))
    payloads = observed.withColumn("text", F.expr(inputs.DOCUMENT)).select(
        F.concat(F.lit("aviationstack_flights_incoming_"), "run_id", F.lit(".json")).alias("file_name"),
        "run_id", F.concat(F.lit('{"data":['), "text", F.lit("]}")).alias("payload"),
    )
    lake = Lake(scratch_path(spark, "lake"))
    ingest(lake, payloads, "aviationstack", "flights", scratch_path(spark, "stream")).awaitTermination()
    return lake


@query("stream_equals_batch", views=("v_obs",), oracle=SNAPSHOT_SQL)
def stream_equals_batch(spark, sf_dir):
    lake = streamed_lake(spark, sf_dir)
    stored = read_table(spark, lake.path("flight_snapshot_insights"), schemas.SNAPSHOT_INSIGHTS)
    return stored.drop("snapshot_at", "created_at")


@query("stream_route_rows", views=("v_obs",), oracle="""
SELECT run_id, COUNT(*) AS routes, COUNT(DISTINCT flight_iata) AS flights FROM v_obs GROUP BY 1""")
def stream_route_rows(spark, sf_dir):
    stored = read_table(spark, streamed_lake(spark, sf_dir).path("flight_aircraft_routes"), schemas.ROUTES)
    return stored.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("routes"), F.count_distinct("flight_iata").alias("flights")
    )


@query("stream_documents", views=("v_obs",), oracle="""
SELECT CAST(CAST(departure_scheduled AS DATE) AS VARCHAR) AS flight_date,
       COUNT(DISTINCT (flight_iata, departure_iata, arrival_iata, airline_iata)) AS documents
FROM v_obs GROUP BY 1""")
def stream_documents(spark, sf_dir):
    stored = read_table(spark, streamed_lake(spark, sf_dir).path("flights"))
    docs = as_documents(scan_recent(stored)).select(R.text_at(F.col("doc"), "flight_date").alias("flight_date"))
    return docs.groupBy("flight_date").agg(F.count(F.lit(1)).alias("documents"))
