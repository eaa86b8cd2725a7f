"""Steps whose tasks, shuffles or expressions must not grow out of proportion."""

import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from harness import landed, landed_queries
from harness.views import BASE_TABLES
from skytally.functions import records as R
from skytally.operators import joins
from skytally.plans import model


def test_input_is_spread_by_its_rows(spark):
    one = spark.range(0, 1000, 1, 1)
    assert joins.spread_input(one, 20).rdd.getNumPartitions() == 50
    assert joins.spread_input(one, None).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert joins.spread_input(spark.range(0, 1000, 1, 60), 20).rdd.getNumPartitions() == 60


def test_document_rules_read_each_path_once(docs):
    rows = docs('{"airline":{"iata":" af "}}', '{"airline":{"iata":"","name":"x"}}', '{"airline":{"icao":false,"name":"y"}}')
    named = rows.select(R.operator_code(F.col("doc")).alias("o"))
    assert [r.o for r in named.collect()] == ["AF", "X", "Y"]
    plan = named._jdf.queryExecution().analyzed().toString()
    assert plan.count("$.airline.iata,") <= 2  # its text, and its type where the text looks empty


@pytest.fixture
def flown(spark, tmp_path):
    """90 events on two days, and the other tables with a row each."""
    start = datetime(2024, 1, 4, 10)
    events = [(n, start + timedelta(days=n % 2, minutes=n), n % 7, "view", 3.0, '{"k": 5}') for n in range(90)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(
        str(tmp_path / "events.parquet"))
    lines = spark.range(0, 400, 1, 4).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("id").alias("l_suppkey"),
        F.lit(8).alias("l_quantity"), F.lit(0.05).alias("l_discount"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    for name in BASE_TABLES:
        if not os.path.exists(tmp_path / f"{name}.parquet"):
            spark.range(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_runs_are_landed_in_files_of_bounded_size(spark, flown, monkeypatch):
    monkeypatch.setattr(landed, "RECORDS_PER_FILE", 10)
    places = landed.payload_files(spark, flown)
    found = glob.glob(f"{places['raw']}/aviationstack_flights_raw_20240104.json")
    assert len(found) > 2
    assert max(open(f).read().count("flight_date") for f in found) < 45
    assert landed.payload_files(spark, flown) == places  # kept, not built again
    rows = {r.run_id: r.records for r in landed_queries.raw_files(spark, flown).collect()}
    assert rows == {"20240104": 45, "20240105": 45}


def test_point_files_are_written_by_the_tasks_that_read(spark, flown):
    folder = landed.point_files(spark, flown)
    assert len(glob.glob(f"{folder}/Flight_Points_Filed_0_*.csv")) > 1
    assert not glob.glob(f"{folder}/**/Flights_*.csv", recursive=True)
    points = landed_queries.point_files(spark, flown)
    assert points.count() == 400 and points.where(F.col("Sequence Number") == 0).count() == 100


def test_fit_runs_on_few_partitions(spark, monkeypatch):
    seen = []

    class Fitted:
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))

    monkeypatch.setattr(model, "build_pipeline", lambda *args, **kwargs: Fitted())
    rows = spark.range(0, 1000, 1, 60)
    model.train(rows, "boosting_notebook")
    monkeypatch.setattr(model, "ROWS_PER_TASK", 100)
    model.train(rows, "boosting_notebook")
    assert seen == [(spark.sparkContext.defaultParallelism, 1000), (10, 1000)]
