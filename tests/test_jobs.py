import json
import random

import pytest
from pyspark.sql import functions as F

from skytally.__main__ import parser
from skytally.plans import insights, jobs, model, runlog
from skytally.schemas import FEATURES, PREDICTIONS, ROUTES, SNAPSHOT_INSIGHTS, TARGET
from skytally.sources import payloads, tables
from skytally.streaming.snapshots import ingest, read_incoming


def flight(number, day="2026-02-27", status="active", dep="CDG", arr="NCE", **extra):
    return {
        "flight_date": day, "flight_status": status, "flight": {"iata": number, "number": number[2:]},
        "airline": {"iata": "AF", "icao": "AFR", "name": "Air"},
        "departure": {"iata": dep, "timezone": "Europe/Paris", "scheduled": f"{day}T10:30:00+00:00", "delay": 20},
        "arrival": {"iata": arr, "timezone": "Europe/Paris"}, **extra,
    }


def land(folder, kind, endpoint, run_id, payload):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"aviationstack_{endpoint}_{kind}_{run_id}.json").write_text(json.dumps(payload))


@pytest.fixture
def lake(tmp_path):
    return jobs.Lake(str(tmp_path / "lake"))


def test_run_etl_loads_once_and_logs(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    land(raw, "raw", "flights", "r1", {"data": [flight("AF1"), flight("AF2", status="landed"), {"x": 1}, 7]})
    counters = jobs.run_etl(spark, lake, str(raw), "Aviationstack", "flights", "r1")
    assert {k: counters[k] for k in ("files", "records", "valid", "invalid", "inserted")} == {
        "files": 1, "records": 4, "valid": 2, "invalid": 2, "inserted": 2}
    land(raw, "raw", "flights", "r2", {"data": [flight("AF1", status="landed"), flight("AF3", day="2026-02-28")]})
    counters = jobs.run_etl(spark, lake, str(raw), "aviationstack", "flights")
    assert (counters["files"], counters["inserted"], counters["updated"]) == (1, 1, 1)
    docs = tables.read_table(spark, lake.path("flights"))
    rows = {r[0]: r[1:] for r in docs.select(
        "flight_number", F.to_json("flight_status"), F.expr("variant_get(_meta,'$.source','string')")).collect()}
    assert rows == {
        "AF1": ('"landed"', "aviationstack"), "AF2": ('"landed"', "aviationstack"), "AF3": ('"active"', "aviationstack")}
    assert {r.run_id for r in spark.read.parquet(lake.path("bronze")).collect()} == {"r1", "r2"}
    runs = spark.read.schema("status string, records_processed bigint, endpoint string, stage string, source string").parquet(
        lake.path("pipeline_runs"))
    assert runs.where("status = 'success'").count() == 2
    events = {r.event for r in spark.read.parquet(lake.path("run_events")).collect()}
    assert {"etl_started", "pipeline_summary"} <= events


def test_run_etl_reference_data_and_failures(spark, tmp_path, lake):
    raw = tmp_path / "raw"
    land(raw, "raw", "airlines", "r1", [{"data": [{"iata_code": "AF", "airline_name": "Air"}]}, {"icao_code": "DLH"}, 3])
    counters = jobs.run_etl(spark, lake, str(raw), "aviationstack", "airlines", "r1")
    assert (counters["records"], counters["inserted"]) == (2, 2)
    with pytest.raises(FileNotFoundError):
        jobs.run_etl(spark, lake, str(raw), "aviationstack", "airports")
    (raw / "aviationstack_flights_raw_bad.json").write_text("{oops")
    with pytest.raises(Exception):
        jobs.run_etl(spark, lake, str(raw), "aviationstack", "flights", "bad")
    failed = spark.read.parquet(lake.path("pipeline_runs")).where("status = 'failed'")
    assert failed.count() == 2
    with pytest.raises(ValueError, match="available: aviationstack/airlines"):
        jobs.get_pipeline("other", "flights")


def files_of(spark, *entries):
    return spark.createDataFrame(
        [(n, r, json.dumps(p)) for n, r, p in entries], "file_name string, run_id string, payload string")


def test_snapshot_job_last_file_wins_and_empty_is_zero(spark, lake):
    files = files_of(
        spark, ("b.json", "r1", {"data": [flight("AF1"), flight("AF2")]}), ("a.json", "r1", {"data": [flight("AF1")]}),
        ("c.json", "r2", {"data": []}))
    for _ in range(2):
        jobs.snapshot_job(spark, lake, files, "aviationstack", "flights")
    rows = tables.read_table(spark, lake.path("flight_snapshot_insights"), SNAPSHOT_INSIGHTS)
    got = {r.run_id: (r.observed_flights_total, r.observed_departure_delays_total, float(r.observed_flights_active_pct))
           for r in rows.collect()}
    assert got == {"r1": (2, 2, 100.0), "r2": (0, 0, 0.0)}


def test_routes_job_replay_and_null_keys(spark, lake):
    files = files_of(spark, ("a.json", "r1", [
        flight("AF1", aircraft={"icao24": "abc"}), flight("AF1", aircraft={"icao24": "abc"}, status="landed"), flight("AF2")]))
    read = lambda: tables.read_table(spark, lake.path("flight_aircraft_routes"), ROUTES)
    for _ in range(2):
        jobs.routes_job(spark, lake, files, "aviationstack", "flights", 1)
        assert {(r.flight_iata, r.flight_status) for r in read().collect()} == {("AF1", "landed"), ("AF2", "active")}
        assert read().count() == 2
    jobs.routes_job(spark, lake, files, "aviationstack", "flights", 2)  # a second load appends the null key
    assert read().where("flight_iata = 'AF2'").count() == 2 and read().count() == 3
    jobs.routes_job(spark, lake, files_of(spark, ("b.json", "r2", [flight("AF9")])), "aviationstack", "flights", 3)
    assert read().groupBy("run_id").count().count() == 2 and read().first().departure_region == "Europe"
    # Another file of r1 under a number used before removes nothing.
    jobs.routes_job(spark, lake, files_of(spark, ("c.json", "r1", [flight("AF5")])), "aviationstack", "flights", 2)
    assert read().where("run_id = 'r1'").count() == 4
    assert insights.latest_route_count(read()).first()[0] == 4


def test_stream_equals_batch_and_archive_ledger(spark, tmp_path, lake):
    incoming = tmp_path / "incoming"
    for n in range(3):
        land(incoming, "incoming", "flights", f"r{n}", {"data": [flight(f"AF{n}"), flight("AF9", status=f"s{n}")]})
    stream = lambda: read_incoming(spark, str(incoming), "aviationstack", "flights", files_per_batch=2)
    run = lambda: ingest(lake, stream(), "aviationstack", "flights", str(tmp_path / "cp")).awaitTermination()
    run()
    read = lambda l, t, s=None: tables.read_table(spark, l.path(t), s)
    snapshot = read(lake, "flight_snapshot_insights", SNAPSHOT_INSIGHTS)
    assert snapshot.count() == 3 and read(lake, "flights").count() == 4
    batch = jobs.Lake(str(tmp_path / "batch"))
    files, _ = payloads.discover_incoming(spark, str(incoming), "aviationstack", "flights")
    jobs.fan_out(spark, batch, files.select("file_name", "run_id", "payload"), "aviationstack", "flights", 0)
    facts = [c for c in SNAPSHOT_INSIGHTS.names if c not in ("snapshot_at", "created_at")]
    same = read(batch, "flight_snapshot_insights", SNAPSHOT_INSIGHTS)
    assert same.select(facts).exceptAll(snapshot.select(facts)).isEmpty()
    assert read(lake, "flight_aircraft_routes").count() == read(batch, "flight_aircraft_routes").count() == 6
    run()  # nothing new
    assert read(lake, "flight_aircraft_routes").count() == 6
    land(incoming, "incoming", "flights", "r8", {"data": [flight("AF8")]})
    run()
    assert read(lake, "flights").count() == 5


@pytest.fixture(scope="module")
def history_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("history")
    rng = random.Random(1)
    header = ("ECTRL ID,ADEP,ADEP Latitude,ADEP Longitude,ADES,ADES Latitude,ADES Longitude,FILED OFF BLOCK TIME,"
              "ACTUAL OFF BLOCK TIME,AC Type,AC Operator,Requested FL,Actual Distance Flown (nm)")
    for month in (3, 6):
        lines = [header]
        for n in range(300):
            hour, late = rng.randrange(24), rng.choice([0, 5, 30])
            ends = ("LFPG", "LFBO") if n % 10 else ("EGLL", "LFBO")
            late = 40 if hour > 15 else late
            lines.append(
                f"{month}{n:04d},{ends[0]},49.0,2.5,{ends[1]},43.6,1.4,{n % 28 + 1:02d}-{month:02d}-2023 {hour:02d}:00:00,"
                f"{n % 28 + 1:02d}-{month:02d}-2023 {hour:02d}:{min(late, 59):02d}:00,A320, op{n % 3},{rng.randrange(200, 380)},310")
        (folder / f"Flights_2023{month:02d}.csv").write_text("\n".join(lines) + "\n")
    (folder / "Flights_broken.csv").write_text("ADEP,ADES\nLFPG,LFBO\n")
    (folder / "airports.csv").write_text(
        "ident,iso_country,iata_code,icao_code,gps_code,latitude_deg,longitude_deg\n"
        "1,FR,CDG,LFPG,LFPG,49,2.5\n2,FR,NCE,LFMN,LFMN,43.6,7.2\n")
    return folder


def test_history_training_and_predictions(spark, lake, history_folder, tmp_path):
    for _ in range(2):  # loading again replaces
        loaded = jobs.history_job(spark, lake, str(history_folder))
        assert loaded["rows"] == 540 and len(loaded["rejected"]) == 1
    path = str(tmp_path / "model")
    report = jobs.training_job(spark, lake, path, numTrees=5, maxDepth=4)
    by_label = {r.label: r for r in report.collect()}
    assert by_label["accuracy"].support == 108 and by_label["accuracy"].f1 > 0.6
    assert json.loads(spark.read.text(path + ".metadata").first()[0])["feature_columns"] == FEATURES

    files = files_of(spark, ("a.json", "r1", {"data": [
        flight("AF1"), flight("AF2", arr="JFK"), flight("AF3", dep="NTE"), flight("AF4", airline={})]}))
    jobs.load_documents(spark, lake, files, "flights", "aviationstack", "r1")
    for _ in range(2):
        assert jobs.prediction_job(spark, lake, path, str(history_folder / "airports.csv")) == 1
    rows = tables.read_table(spark, lake.path("flight_predictions"), PREDICTIONS).collect()
    # flight_icao is null in the key, so the second run conflicts with nothing
    assert len(rows) == 2 and rows[0].flight_iata == "AF1" and rows[0].model_hour == 10
    assert rows[0].model_requested_fl == 350 and 0 <= rows[0].delay_probability <= 1
    with pytest.raises(FileNotFoundError):
        model.load_model(str(tmp_path / "absent"))


def test_report_covers_all_held_out_rows(spark):
    rows = [(i % 2, 1 + i % 12, i % 7, 300 + i, 100.0 + i, "AFR", 1.0, 2.0, float(i)) for i in range(400)]
    dataset = spark.createDataFrame(rows, [TARGET, *FEATURES]).select(TARGET, *FEATURES)
    fitted, report = model.train_and_evaluate(dataset, max_rows=50, numTrees=2, maxDepth=2)
    assert {r.label: r.support for r in report.collect()}["accuracy"] == 80
    assert fitted.stages[-1].numFeatures > 0


def test_fit_takes_every_training_row(spark, monkeypatch):
    i = F.col("id")
    dataset = spark.range(375_100).select(
        (i % 2).alias(TARGET), (i % 12 + 1).alias("month"), (i % 7).alias("day_of_week"), (300 + i).alias("Requested FL"),
        (i / 7).alias("Actual Distance Flown (nm)"), F.lit("AFR").alias("AC Operator"), F.lit(1.0).alias("Latitude"),
        F.lit(2.0).alias("Longitude"), (i % 24).alias("hour"))
    fit, fitted_on = model.train, []

    def counted(rows, *args, **kwargs):
        fitted_on.append(rows.count())
        return fit(rows, *args, **kwargs)

    monkeypatch.setattr(model, "train", counted)
    _, report = model.train_and_evaluate(dataset, "boosting_notebook", maxIter=1, maxDepth=1)
    assert fitted_on == [300_080]
    assert report.first().support + report.collect()[1].support == 75_020


def test_training_guards(spark):
    schema = f"{TARGET} string, " + ", ".join(f"`{c}` string" for c in FEATURES)
    row = ["0", "1", "2", "350", "100", "AFR", "1", "2", "3"]
    one_class = spark.createDataFrame([row, row], schema)
    with pytest.raises(ValueError, match="one class"):
        model.prepare_training(one_class)
    with pytest.raises(ValueError, match="empty"):
        model.prepare_training(one_class.limit(0))
    with pytest.raises(ValueError, match="month"):
        model.prepare_training(one_class.drop("month"))
    mixed = spark.createDataFrame([row, ["1", *row[1:]], ["1", "bad", *row[2:]]], schema)
    assert model.prepare_training(mixed).count() == 2
    with pytest.raises(ValueError):
        model.build_pipeline("other")


def test_unknown_operator_and_seed(spark):
    rows = [(i % 2, float(i), 1.0, 300.0, 100.0 + i, f"OP{i % 2}", 1, i % 24, 1) for i in range(120)]
    types = dict.fromkeys(FEATURES, "double") | {"AC Operator": "string", "month": "int", "hour": "int", "day_of_week": "int"}
    data = spark.createDataFrame(rows, f"{TARGET} bigint, " + ", ".join(f"`{c}` {t}" for c, t in types.items()))
    fitted = model.train(data, numTrees=3, minInstancesPerNode=1)
    unseen = data.limit(1).withColumn("AC Operator", F.lit("NEW"))
    features = fitted.transform(unseen).first().features.toArray()
    assert list(features[7:]) == [0.0, 0.0]
    again = model.train(data, numTrees=3, minInstancesPerNode=1)
    assert model.score(fitted, data).collect() == model.score(again, data).collect()
    weights = dict(model.balance_weights(data.limit(120)).groupBy(TARGET).agg(F.sum(model.WEIGHT)).collect())
    assert weights == {0: 60.0, 1: 60.0}
    boosted = model.train(data, "boosting_notebook", maxIter=2)
    assert model.score(boosted, data).where("delay_probability is null").isEmpty()


def test_confusion_report_without_positives(spark):
    rows = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    got = {r.label: (r.precision, r.recall, r.f1, r.support) for r in model.confusion_report(rows, "y", "p").collect()}
    assert got["delayed"] == (0.0, 0.0, 0.0, 0) and got["on_time"] == (1.0, 1.0, 1.0, 2)


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    common = dict(source=" S ", endpoint="Flights", stage="load")
    runlog.record_run(spark, path, status="Success", duration_seconds=2, records_processed=5, **common)
    runlog.record_run(spark, path, status="failed", duration_seconds=1, **common)
    with pytest.raises(ValueError):
        runlog.record_run(spark, path, status="odd", duration_seconds=1, **common)
    runs = spark.read.parquet(path)
    gauge = runlog.gauges(runs).first()
    assert (gauge.source, gauge.last_status, gauge.max_duration_seconds, gauge.max_records_processed) == ("s", 0, 2.0, 5)
    assert runlog.failure_rate(runs).first()[0] == 50.0
    assert runlog.failure_rate(runs.limit(0)).first()[0] == 0.0
    assert runlog.forget_runs(runs, **common).isEmpty()
    assert runlog.selected(runs, endpoint="fli").isEmpty()


def test_command_line():
    args = parser().parse_args(["--lake", "l", "run-etl", "--raw", "r", "--endpoint", "airlines"])
    assert (args.command, args.source, args.endpoint, args.run_id) == ("run-etl", "aviationstack", "airlines", None)
    assert parser().parse_args(["--lake", "l", "train", "--model", "m"]).preset == "forest_job"


def test_documents_keep_their_keys_as_they_came(spark, lake):
    days = ("", "007", "7", None, "2026-02-27", "2026-02-30")
    first = files_of(spark, ("a.json", "r1", [flight("AF1", day=d) for d in days]), ("b.json", "r1", []))
    jobs.load_documents(spark, lake, first, "flights", "aviationstack", "r1")
    before = {(r.flight_date, r.flight_number) for r in jobs.read_documents(spark, lake, "flights").collect()}
    assert {d for d, _ in before} >= {"", "007", "7", "2026-02-27", "2026-02-30"}
    again = files_of(spark, ("c.json", "r2", [flight("AF1", day="007"), flight("AF2", day="")]), ("d.json", "r2", []))
    counters = jobs.load_documents(spark, lake, again, "flights", "aviationstack", "r2")
    assert (counters["files"], counters["inserted"], counters["unchanged"]) == (2, 1, 1)
    after = [(r.flight_date, r.flight_number) for r in jobs.read_documents(spark, lake, "flights").collect()]
    assert sorted(after, key=str) == sorted(before | {("", "AF2")}, key=str)


def test_history_files_of_one_name_and_files_without_rows(spark, lake, tmp_path):
    header = ("ECTRL ID,ADEP,ADEP Latitude,ADEP Longitude,ADES,ADES Latitude,ADES Longitude,FILED OFF BLOCK TIME,"
              "ACTUAL OFF BLOCK TIME,AC Type,AC Operator,Requested FL,Actual Distance Flown (nm)")

    def write(year, *origins):
        folder = tmp_path / "csv" / year
        folder.mkdir(parents=True, exist_ok=True)
        lines = [f"{n},{o},49.0,2.5,LFBO,43.6,1.4,01-03-2023 10:00:00,01-03-2023 10:20:00,A320,AFR,350,310"
                 for n, o in enumerate(origins)]
        (folder / "Flights_03.csv").write_text("\n".join([header, *lines]) + "\n")

    load = lambda: jobs.history_job(spark, lake, str(tmp_path / "csv"))["rows"]
    write("y 1", "LFPG", "LFPG")
    write("y2", "LFPG")
    assert load() == 3 and load() == 3
    write("y 1", "EGLL")
    assert load() == 1
