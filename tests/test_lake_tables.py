"""Postings, run index, quarantine and stored schemas of the lake."""

import json
import os
import random
import re
import threading
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions import variants
from skytally.operators import search
from skytally.operators.trigrams import TrigramIndex, literal_parts
from skytally.plans import explorer, insights, jobs, quarantine, runlog
from skytally.schemas import ROUTES, RUN_EVENTS, RUN_LOG, SNAPSHOT_INSIGHTS
from skytally.session import scratch_path
from skytally.sources import csv_files, payloads, table_schemas, tables
from skytally.streaming.snapshots import ingest, read_incoming

IDS = ["flight_iata", "flight_icao", "flight_number"]


@pytest.mark.parametrize("pattern, parts", [
    ("abc", ["abc"]), ("a_bcd%e", ["a", "bcd", "e"]), ("%_%", []), (r"a\%b\\c", [r"a%b\c"]), ("x\\", ["x\\"]), ("", [])])
def test_literal_parts_of_a_pattern(pattern, parts):
    assert literal_parts(pattern) == parts


@pytest.fixture(scope="module")
def flights(spark):
    """Flights of four days, one day unknown; identifiers with wildcards, nulls and short texts."""
    rows = [(i, f"AF{i * 7 % 900}", f"AFR{i % 90}" if i % 5 else None, None if i % 11 == 0 else i % 4) for i in range(600)]
    rows += [(9001, "Ünï%co_de", "x", 1), (9002, "ab", "cd", 1), (9003, None, None, None), (9004, "AF_7%", "İzmir", 2)]
    df = spark.createDataFrame(rows, "flight_number long, flight_iata string, flight_icao string, day int")
    path = scratch_path(spark, "flights")
    df.write.partitionBy("day").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def index_of(spark, fields=IDS):
    return TrigramIndex(scratch_path(spark, "trigrams"), tuple(fields), ("flight_number",), "day")


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


NEEDLES = ["af12", "AFR8", " fr1 ", "r_9", "a%7", "", "  ", "%", "ünï", "co_d", "12", "nothing", "AF1%3", r"AF\_7", r"\%", "İzm", "900"]


def test_indexed_searches_equal_the_scan(spark, flights):
    index = index_of(spark)
    same(index.like_any_id(flights, "af12"), search.like_any_id(flights, "af12"))  # no index yet
    half = F.col("flight_number") % 2 == 0
    index.add(flights.where(half))
    index.add(flights.where(~half))
    for needles in (NEEDLES, NEEDLES[:4]):
        for needle in needles:
            same(index.like_any_id(flights, needle), search.like_any_id(flights, needle))
            same(index.contains_text(flights, needle), search.contains_text(flights, needle))
        index.add(flights.limit(50))  # a replay
        # Postings of rows that have changed since.
        index.add(flights.withColumn("flight_iata", F.lit("AF12")).limit(9))
        before = index.stored(spark).distinct().count()
        index.compact(spark)
        assert index.stored(spark).count() == before
    long = "AF" + "x" * 200
    assert index.like_any_id(flights, long).count() == 0


def test_search_reads_postings_and_few_partitions(spark, flights):
    index = index_of(spark)
    index.keep_up(flights, flights.limit(0))  # first time: the whole table
    near = index.narrow(flights, ["zmir"])
    assert [r.flight_number for r in near.collect()] == [9004]
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*day#\d+ = 2", plan)
    postings = index.candidates(spark, ["zmir"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[folder#\d+ (IN|=)", postings) and "In(gram" in postings


def test_columns_that_are_not_indexed_are_scanned(spark, flights):
    index = index_of(spark, ["flight_iata"])
    index.add(flights)
    same(index.like_any_id(flights, "AFR8"), search.like_any_id(flights, "AFR8"))


# --- run index ---------------------------------------------------------------------------------


def payload_files(spark, *entries):
    return spark.createDataFrame(
        [(f, r, json.dumps(p)) for f, r, p in entries], "file_name string, run_id string, payload string")


def flight(number, zone="Europe/Paris"):
    return {"flight_date": "2026-02-27", "flight": {"iata": number}, "departure": {"iata": "CDG", "timezone": zone},
            "arrival": {"iata": "NCE", "timezone": "Asia/Tokyo"}}


def test_run_index_follows_the_routes(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path / "lake"))
    assert jobs.read_runs(spark, lake) is None
    load = lambda seq, *entries: jobs.routes_job(
        spark, lake, payload_files(spark, *entries), "aviationstack", "flights", seq)
    load(1, ("b", "manual__2026-03-01T10", [flight("A1"), flight("A2")]), ("a", "r1", [flight("A3")]))
    load(2, ("c", "20260228_101500", [flight("A4", "Africa/Cairo")]))
    load(1, ("a", "r1", [flight("A3"), flight("A5")]))  # a replay that found more

    def check():
        runs = jobs.read_runs(spark, lake)
        routes = tables.read_table(spark, lake.path("flight_aircraft_routes"), ROUTES)
        whole = insights.route_runs(routes)
        assert sorted(map(tuple, runs.collect())) == sorted(map(tuple, whole.collect()))
        wanted = insights.of_latest_run(routes).count()
        assert jobs.route_dashboard(spark, lake)["total_routes"].first()[0] == wanted
        return {r.run_id: r.run_day for r in runs.collect()}, routes, runs

    days, routes, runs = check()
    assert days == {"manual__2026-03-01T10": "20260301", "r1": "other", "20260228_101500": "20260228"}
    latest = insights.of_latest_run(routes, runs=runs)
    assert {r.run_id for r in latest.collect()} == {"r1"}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*run_id#\d+ = Subquery", plan)
    assert "ReadSchema: struct<run_id:string,created_at:timestamp,loaded_seq" in plan.split("Subquery", 1)[1]
    tables.drop_partition(spark, lake.path("route_runs"))  # a table from before the index
    assert jobs.route_dashboard(spark, lake)["total_routes"].first()[0] == 2
    load(3, ("d", "20260302", [flight("A6")]))
    assert len(check()[0]) == 4


def test_snapshots_rewrite_only_the_days_they_touch(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path / "lake"))
    run = lambda *entries: jobs.snapshot_job(spark, lake, payload_files(spark, *entries), "aviationstack", "flights")
    run(("a", "20260301_00", [flight("A1")]), ("b", "20260302_00", [flight("A2"), flight("A3")]))
    kept = [p for p in (tmp_path / "lake" / "flight_snapshot_insights").rglob("*.parquet") if "20260301" in str(p)]
    written = run(("c", "20260302_00", [flight("A4")]), ("d", "20260302_01", []))
    assert written.columns == SNAPSHOT_INSIGHTS.names
    stored = tables.read_table(spark, lake.path("flight_snapshot_insights"), SNAPSHOT_INSIGHTS)
    assert {r.run_id: r.observed_flights_total for r in stored.collect()} == {
        "20260301_00": 1, "20260302_00": 1, "20260302_01": 0}
    assert stored.columns == SNAPSHOT_INSIGHTS.names and all(p.exists() for p in kept)


# --- flat view of documents --------------------------------------------------------------------


def plain_flat(document, prefix=""):
    """Dotted leaves of a JSON object, as a data frame library normalises them."""
    out = {}
    for name, value in document.items():
        if isinstance(value, dict) and value:
            out.update(plain_flat(value, f"{prefix}{name}."))
        else:
            out[prefix + name] = value
    return out


def random_document(rng, depth=0):
    names = ["a", "b", "x y", "g.h", "q's", 'd"q', "Ünï", ""]
    out = {}
    for name in rng.sample(names, rng.randint(0, 4)):
        kind = rng.randrange(8)
        if kind < 3 and depth < 3:
            out[name] = random_document(rng, depth + 1)
        else:
            out[name] = [1, -2.5, "text", True, None, [1, {"k": 2}], "7", 10 ** 12][kind]
    return out


def test_flat_documents_have_every_leaf(spark):
    rng = random.Random(3)
    documents = [random_document(rng) for _ in range(80)]
    texts = [json.dumps(d) for d in documents] + ["[1,2]", '"x"', "null"]
    rows = spark.createDataFrame(list(enumerate(texts)), "ix int, text string").repartition(5)
    docs = rows.select("ix", F.parse_json("text").alias("doc"))
    flat = explorer.flat_documents(docs.select("doc"))
    wanted = [plain_flat(d) for d in documents]
    named = {k for w in wanted for k, v in w.items()}
    hidden = {k for k in named if all(w.get(k) is None or w.get(k) == {} for w in wanted)}
    assert named - hidden <= set(flat.columns) <= named
    # Values by document: one column each for name and value, as text.
    pairs = docs.select("ix", F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), c.cast("string").alias("v")) for n, c in variants.leaf_columns(docs).items()])).alias("p"))
    got = {(r.ix, r.p.n): r.p.v for r in pairs.where("p.v is not null").collect()}
    for ix, w in enumerate(wanted):
        for name, value in w.items():
            if value is None or value == {}:
                assert got.pop((ix, name), "{}") == "{}"
                continue
            text = got.pop((ix, name))
            if isinstance(value, str):
                assert text == value
            elif isinstance(value, list):
                assert json.loads(text) == value
            else:
                assert json.loads(text) == pytest.approx(value)
    assert not got


def test_flat_documents_order_and_empty(spark):
    docs = spark.createDataFrame([('{"zz":1,"live":{"is_ground":true},"flight":{"iata":"A1"},"flight_date":"d"}',)], "t string")
    docs = docs.select(F.parse_json("t").alias("doc"))
    assert explorer.flat_documents(docs).columns == ["flight_date", "flight.iata", "live.is_ground", "zz"]
    assert explorer.flat_documents(docs.where("false")).columns == []
    wide = spark.range(3).select(F.parse_json(F.format_string('{"k%d":{"a":1}}', "id")).alias("doc"))
    assert len(explorer.flat_documents(wide).columns) == 3


def test_snapshot_files_by_rank(spark, tmp_path):
    incoming, processed = tmp_path / "in", tmp_path / "done"
    find = lambda: sorted(r.file_name for r in payloads.find_snapshot_files(
        spark, str(incoming), str(processed), "S", "flights", "r1").collect())
    with pytest.raises(FileNotFoundError):
        find()
    for folder, name in [
        (processed / "x", "note_r1.txt"), (processed, "a_r1_b.json"), (incoming, "c_r1_.json"), (incoming, "r1.txt"),
        (processed / "y", "q__s_flights_incoming_r1.json"), (processed / "z", "s_flights_incoming_r1.json"),
        (incoming, "s_flights_incoming_r1.json"),
    ]:
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("{}")
        if name != "r1.txt":
            assert find() == [name]


# --- quarantine --------------------------------------------------------------------------------


def aside(spark, lake):
    rows = quarantine.quarantined(spark, lake.path("quarantine"))
    return sorted((r.file_name.rsplit("/", 1)[-1], r.record_ix, r.reason, r.content) for r in rows.collect())


def test_loads_set_bad_files_and_records_aside(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path / "lake"))
    files = spark.createDataFrame([
        ("a.json", json.dumps({"data": [flight("A1"), {"x": 1}, 7]})), ("b.json", "{oops"), ("c.json", "3"),
        ("d.json", json.dumps({"data": []})), ("e.json", None), ("f.json", ""), ("g.json", json.dumps([flight("A2"), None]))],
        "file_name string, payload string")
    wanted = [
        ("a.json", 1, "invalid_key", '{"x":1}'), ("a.json", 2, "not_an_object", "7"), ("b.json", None, "bad_json", "{oops"),
        ("c.json", None, "no_record_list", "3"), ("e.json", None, "bad_json", None), ("f.json", None, "bad_json", ""),
        ("g.json", 1, "not_an_object", "null")]
    for _ in range(2):  # a load that is repeated replaces what it set aside
        counters = jobs.load_documents(spark, lake, files, "flights", "aviationstack", "manual__2026-03-01T10:00:00+00:00")
        assert {k: counters[k] for k in ("files", "records", "valid", "invalid", "unread_files")} == {
            "files": 7, "records": 5, "valid": 2, "invalid": 3, "unread_files": 4}
        assert sorted(aside(spark, lake), key=repr) == sorted(wanted, key=repr)
    jobs.load_documents(spark, lake, files.where("file_name = 'b.json'"), "airlines", "aviationstack", "r2")
    assert {(r.endpoint, r.reason, r.rows, r.files) for r in quarantine.reasons(
        quarantine.quarantined(spark, lake.path("quarantine"))).where("endpoint = 'airlines'").collect()} == {
            ("airlines", "bad_json", 1, 1)}
    # Mended files: nothing is left of the load.
    mended = files.where("file_name in ('d.json')")
    jobs.load_documents(spark, lake, mended, "flights", "aviationstack", "manual__2026-03-01T10:00:00+00:00")
    assert [r[0] for r in aside(spark, lake)] == ["b.json"]
    assert {r.flight_number for r in jobs.read_documents(spark, lake, "flights").collect()} == {"A1", "A2"}


def test_poison_file_does_not_stop_the_stream(spark, tmp_path):
    lake, landed = jobs.Lake(str(tmp_path / "lake")), tmp_path / "in"
    landed.mkdir()
    name = lambda run: landed / f"aviationstack_flights_incoming_{run}.json"
    name("r1").write_text('{"data": [')
    name("r2").write_text(json.dumps({"data": [flight("A1")]}))

    def load():
        stream = read_incoming(spark, str(landed), "aviationstack", "flights")
        ingest(lake, stream, "aviationstack", "flights", str(tmp_path / "cp")).awaitTermination()

    load()
    name("r3").write_text(json.dumps({"data": [flight("A2")]}))
    load()
    assert {r.flight_number for r in jobs.read_documents(spark, lake, "flights").collect()} == {"A1", "A2"}
    assert [(r[0], r[2], r[3]) for r in aside(spark, lake)] == [
        ("aviationstack_flights_incoming_r1.json", "bad_json", '{"data": [')]
    assert {r.run_id for r in jobs.read_runs(spark, lake).collect()} == {"r2", "r3"}


def test_history_sets_corrupt_records_aside(spark, tmp_path):
    lake, folder = jobs.Lake(str(tmp_path / "lake")), tmp_path / "csv"
    folder.mkdir()
    header = ("ECTRL ID,ADEP,ADEP Latitude,ADEP Longitude,ADES,ADES Latitude,ADES Longitude,FILED OFF BLOCK TIME,"
              "ACTUAL OFF BLOCK TIME,AC Type,AC Operator,Requested FL,Actual Distance Flown (nm)")
    line = "{},LFPG,49.0,2.5,LFBO,43.6,1.4,01-03-2023 10:00:00,01-03-2023 10:20:00,A320,{},350,310"
    write = lambda name, *lines: (folder / name).write_bytes("\n".join([header, *lines, ""]).encode("latin-1"))
    extra = line.format(2, "Zé") + ",boom,x"
    write("Flights_1.csv", line.format(1, '"a, b"'), extra, line.format(3, "op") + ",")
    write("Flights_2.csv", line.format(4, "op"), line.format(5, "op").rsplit(",", 1)[0])  # one value short: kept
    (folder / "Flights_3.csv").write_text("ADEP,ADES\nLFPG,LFBO\n")
    for _ in range(2):
        done = jobs.history_job(spark, lake, str(folder))
        assert (done["rows"], done["set_aside"], len(done["rejected"])) == (4, 1, 1)
        found = aside(spark, lake)
        assert [(r[0], r[2]) for r in found] == [("Flights_1.csv", "extra_fields"), ("Flights_3.csv", "missing_columns")]
        assert found[0][3] == extra and "ACTUAL OFF BLOCK TIME" in found[1][3]
    write("Flights_1.csv", line.format(1, "op"))
    done = jobs.history_job(spark, lake, str(folder))
    assert (done["rows"], done["set_aside"]) == (3, 0) and [r[0] for r in aside(spark, lake)] == ["Flights_3.csv"]


# --- stored schemas ----------------------------------------------------------------------------


def test_types_widen_or_fail(spark):
    wide = lambda a, b: table_schemas.widened(T.StructType.fromDDL(a), T.StructType.fromDDL(b)).simpleString()
    assert wide("a int, s struct<x: int>", "b string, a bigint, s struct<x: bigint, y: date>") == (
        "struct<a:bigint,s:struct<x:bigint,y:date>,b:string>")
    assert wide("a bigint, b float, c decimal(5,2), d array<tinyint>", "a smallint, b int, c decimal(6,4), d array<int>") == (
        "struct<a:bigint,b:double,c:decimal(7,4),d:array<int>>")
    assert wide("a void", "a date") == wide("a date", "a void") == "struct<a:date>"
    for a, b in (("a int", "a string"), ("a bigint", "a double"), ("s struct<x: int>", "s struct<x: date>")):
        with pytest.raises(ValueError, match="cannot hold"):
            wide(a, b)


def jobs_of(spark, action):
    """Number of Spark jobs an action runs."""
    group = f"counted-{random.random()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        action()
    finally:
        spark.sparkContext.setJobGroup("rest", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_tables_are_read_by_their_stored_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    put = lambda sql, **how: tables.put(spark.sql(sql), path, **how)
    assert tables.read_table(spark, path) is None
    put("select 'p1' p, cast(1 as int) a", partition_by=("p",))
    put("select 'p2' p, cast(7000000000 as bigint) a, 'x' `b c`", partition_by=("p",))
    put("select 'p3' p, 'y' `b c`", partition_by=("p",), mode="append")
    read = lambda: tables.read_table(spark, path)
    assert sorted(map(tuple, read().select("p", "a", "`b c`").collect())) == [
        ("p1", 1, None), ("p2", 7000000000, "x"), ("p3", None, "y")]
    assert jobs_of(spark, read) == 0 < jobs_of(spark, lambda: spark.read.parquet(path))
    with pytest.raises(Exception, match="CANNOT_MERGE"):  # the footers alone do not go together
        spark.read.option("mergeSchema", True).parquet(path)
    with pytest.raises(ValueError):
        put("select 'p1' p, 'text' a", partition_by=("p",))
    assert read().where("p = 'p1'").select("a").first()[0] == 1  # nothing was written
    put("select 'p1' p, cast(5 as int) a", partition_by=("p",))
    assert {r.p: r.a for r in read().collect()} == {"p1": 5, "p2": 7000000000, "p3": None}
    assert sorted(p.name for p in (tmp_path / "t" / "_schema").glob("*.json")) == ["1.json", "2.json"]
    # A table from before, without a stored schema, and one that is replaced as a whole.
    old = str(tmp_path / "old")
    spark.sql("select 1 a").write.parquet(old)
    assert tables.read_table(spark, old).columns == ["a"]
    tables.put(spark.sql("select 2 b"), old)
    assert tables.read_table(spark, old).columns == ["b"]


def test_schema_writers_do_not_lose_each_others_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    threads = [threading.Thread(target=table_schemas.keep_schema, args=(
        spark, path, T.StructType.fromDDL(f"c{n} int"))) for n in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(table_schemas.stored_schema(spark, path).names) == [f"c{n}" for n in range(6)]


def test_a_schema_number_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "t")
    table_schemas.keep_schema(spark, path, T.StructType.fromDDL("a int"))
    folder, files = table_schemas._place(spark, path)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    files.create(path_of(folder, ".late"), False).close()
    assert not table_schemas._numbered(spark, files, path_of(folder, ".late"), path_of(folder, "1.json"))
    assert table_schemas.stored_schema(spark, path).names == ["a"]
    # Writers of many columns at once, several times over.
    for n in range(3):
        threads = [threading.Thread(target=table_schemas.keep_schema, args=(
            spark, f"{path}{n}", T.StructType.fromDDL(f"c{k} int"))) for k in range(12)]
        for thread in threads:
            thread.start()
        for thread in threads:
            thread.join()
        assert len(table_schemas.stored_schema(spark, f"{path}{n}").names) == 12


def test_a_load_reads_its_files_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [("a", '{"data":[{"flight_date":"2024-01-01","flight":{"iata":"X1"}},{"flight":{}}]}'), ("b", "{cut")]
    files = spark.createDataFrame(rows, "file_name string, payload string").mapInArrow(counted, "file_name string, payload string")
    counters = jobs.load_documents(spark, jobs.Lake(str(tmp_path)), files, "flights", "s", "r")
    assert seen.value == 2
    assert [counters[k] for k in ("files", "unread_files", "records", "invalid", "valid")] == [2, 1, 2, 1, 1]


def test_csv_files_of_one_name_keep_their_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    for folder, text in (("a b", "x,y\n1,2\n"), ("c", "x, z\n3,4\n5,6\n")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "f.csv").write_text(text)
    load = lambda folder: tables.append_csv(spark, str(tmp_path / folder / "f.csv"), table)
    assert (load("a b"), load("c"), load("a b")) == (1, 2, 1)
    rows = tables.read_table(spark, table).select("x", "y", "z").collect()
    assert sorted(map(tuple, rows)) == [("1", "2", None), ("3", None, "4"), ("5", None, "6")]


# --- run metrics over a time range ---------------------------------------------------------------


def test_series_carry_the_last_run_forward(spark):
    rng, start = random.Random(8), datetime(2024, 3, 1)
    over = runlog.TimeRange(start, start + timedelta(hours=10, minutes=5), 1800)
    rows = []
    for n in range(120):
        at = start + timedelta(seconds=rng.choice([rng.randrange(-9000, 50_000), 1800 * rng.randrange(-3, 24)]))
        rows.append(("s", rng.choice("ef"), rng.choice("gh"), rng.choice(["success", "failed"]), f"r{n:03d}", at,
                     float(n), None if n % 4 == 0 else n))
    rows.append(("s", "late", "g", "success", "x", start + timedelta(days=2), 1.0, 1))
    rows.append(("s", "unknown", "g", "success", "x", None, 1.0, 1))
    runs = spark.createDataFrame(rows, RUN_LOG).repartition(5)
    points = [start + timedelta(seconds=1800 * k) for k in range(21)]
    wanted = []
    for at in points:
        for group in {r[:3] for r in rows}:
            seen = [r for r in rows if r[:3] == group and r[5] and r[5] <= at]
            if seen:
                last = max(seen, key=lambda r: (r[5], r[4]))
                wanted.append((at, *group, int(last[3] == "success"), last[6], last[7]))
    assert sorted(map(repr, map(tuple, runlog.metric_series(runs, over).collect()))) == sorted(map(repr, wanted))
    held = [r for r in rows if r[5] and points[0] < r[5] <= points[-1]]
    wanted = [(at, *group, sum(r[1:4] == group and at - timedelta(seconds=1800) < r[5] <= at for r in held))
              for at in points[1:] for group in {r[1:4] for r in held}]
    assert sorted(map(tuple, runlog.executions_by_step(runs, over).collect())) == sorted(wanted)
    one = runlog.TimeRange(start, start, 60)
    assert {r.at for r in runlog.metric_series(runs, one).collect()} == {start}
    assert runlog.executions_by_step(runs, one).count() == 0
    for bad in ((start, start - timedelta(1), 60), (start, start, 0), (start, start + timedelta(days=30), 60)):
        with pytest.raises(ValueError):
            runlog.TimeRange(*bad)


# --- run log upkeep -------------------------------------------------------------------------------


def test_log_is_compacted_and_label_groups_are_deleted(spark, tmp_path):
    path = str(tmp_path / "runs")
    start = datetime(2026, 3, 1, 10)
    for n in range(9):
        runlog.record_run(
            spark, path, source="S", endpoint="a+b c%/é" if n % 2 else "flights", stage="load", status="success",
            duration_seconds=n, run_id=f"r{n}", finished_at=start + timedelta(days=n // 4))
    files = lambda: len(list((tmp_path / "runs").rglob("*.parquet")))
    read = lambda: sorted(map(tuple, runlog.read_runs(spark, path).collect()))
    before, rows = files(), read()
    assert before == 9
    runlog.compact(spark, path, RUN_LOG, "2026-03-02")
    assert read() == rows and files() == 2 + 5
    runlog.compact(spark, path, RUN_LOG, "2026-03-04")
    assert read() == rows and files() == 5
    untouched = {p for p in (tmp_path / "runs").rglob("*.parquet")}
    runlog.compact(spark, path, RUN_LOG, "2026-03-04")
    assert untouched == {p for p in (tmp_path / "runs").rglob("*.parquet")}
    assert runlog.delete_runs(spark, path, source="s", endpoint=" A+B C%/É", stage="load") == 2
    assert read() == [r for r in rows if r[1] == "flights"] and files() == 3
    assert runlog.delete_runs(spark, path, source="s", endpoint="none", stage="load") == 0
    runlog.compact(spark, str(tmp_path / "nothing"), RUN_LOG, "2026-03-04")
    events = str(tmp_path / "events")
    for n in range(3):
        runlog.log_event(spark, events, "info", "load", "done", n=n)
    runlog.compact(spark, events, RUN_EVENTS, "9999-01-01")
    assert len(list((tmp_path / "events").rglob("*.parquet"))) == 1
    assert {json.loads(r.details)["n"] for r in tables.read_table(spark, events, RUN_EVENTS).collect()} == {0, 1, 2}


# --- headers of many files ------------------------------------------------------------------------


def test_headers_of_many_files_by_few_jobs(spark, tmp_path):
    lines = {"a,b": 9, "b, c ": 4, "﻿x,Zé": 3}
    for n, (line, count) in enumerate(lines.items()):
        for k in range(count):
            folder = tmp_path / f"y {n}" / f"m+{k}"
            folder.mkdir(parents=True)
            ending = "\r\n" if k % 2 else "\n"
            (folder / "Flights_1.csv").write_bytes((("\n" * (k % 3)) + line + ending + ("1,2" + ending) * 40).encode())
    (tmp_path / "Flights_blank.csv").write_text("\n\n")
    got = {}
    few = jobs_of(spark, lambda: got.update(csv_files.headers(spark, str(tmp_path), "Flights_*.csv")))
    counts = Counter()  # a byte order mark may stay in a name until it is cleaned
    for names, paths in got.items():
        counts[tuple(csv_files._clean_name(n) for n in names)] += len(paths)
    assert counts == {("a", "b"): 9, ("b", "c"): 4, ("x", "Zé"): 3, (): 1}
    for names, paths in got.items():
        for path in paths[:2] if names else []:
            assert [csv_files._clean_name(n) for n in csv_files._header(spark, path)] == [csv_files._clean_name(n) for n in names]
    rows, rejected = csv_files.scan_history(spark, str(tmp_path), ["b"])
    assert rows.count() == 13 * 40 and len(rejected) == 4
    # As many jobs for twice the files.
    for k in range(9):
        folder = tmp_path / "z" / str(k)
        folder.mkdir(parents=True)
        (folder / "Flights_1.csv").write_text("a,b\n1,2\n")
    again = jobs_of(spark, lambda: got.update(csv_files.headers(spark, str(tmp_path), "Flights_*.csv")))
    assert again <= few + 9 and len(got[("a", "b")]) == 18
    assert csv_files.headers(spark, str(tmp_path / "none"), "Flights_*.csv") == {}


def test_first_lines_of_split_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_files, "SPLIT_BYTES", 1000)
    for n in range(3):
        (tmp_path / f"Flights_{n}.csv").write_text(f"h{n},b\n" + "1234567,7654321\n" * 500)
    assert csv_files.headers(spark, str(tmp_path), "Flights_*.csv").keys() == {(f"h{n}", "b") for n in range(3)}


def test_payloads_that_land_again_are_loaded_once(spark, tmp_path):
    lake, landed = jobs.Lake(str(tmp_path / "lake")), tmp_path / "in"
    landed.mkdir()

    def land(run, payload):
        path = landed / f"aviationstack_flights_incoming_{run}.json"
        path.write_text(payload)
        os.utime(path, (1_000_000_000, 1_000_000_000))  # an old file is no late one

    def load():
        stream = read_incoming(spark, str(landed), "aviationstack", "flights")
        ingest(lake, stream, "aviationstack", "flights", str(tmp_path / "cp"), "1 day").awaitTermination()

    one, two = json.dumps({"data": [flight("A1")]}), json.dumps({"data": [flight("A1"), flight("A2")]})
    land("r1", one)
    land("r1-again", one)
    load()
    land("r2", one)
    land("r3", two)
    land("r4", "{bad")
    land("r5", "{bad")
    load()
    routes = tables.read_table(spark, lake.path("flight_aircraft_routes"), ROUTES)
    counts = sorted(r["count"] for r in routes.groupBy("run_id").count().collect())
    assert counts == [1, 2] and len(aside(spark, lake)) == 1


def test_seen_payloads_are_kept_on_disk(spark, tmp_path, monkeypatch):
    provider, landed = "spark.sql.streaming.stateStore.providerClass", tmp_path / "in"
    landed.mkdir()

    def load(name, *payloads):
        """Routes of the lake once the payloads are in, and whether the digests seen are in RocksDB."""
        for run, payload in payloads:
            (landed / f"aviationstack_flights_incoming_{run}.json").write_text(payload)
        lake, stream = jobs.Lake(str(tmp_path / name)), read_incoming(spark, str(landed), "aviationstack", "flights")
        query = ingest(lake, stream, "aviationstack", "flights", str(tmp_path / f"{name}-cp"), "1 day")
        query.awaitTermination()
        used = {any("rocksdb" in key for key in o["customMetrics"]) for p in query.recentProgress for o in p["stateOperators"]}
        assert spark.conf.get(provider, None) is None
        return tables.read_table(spark, lake.path("flight_aircraft_routes"), ROUTES).count(), used

    one, two = (json.dumps({"data": [flight(n)]}) for n in ("A1", "A2"))
    with monkeypatch.context() as patch:  # as checkpoints were begun before
        patch.setattr("skytally.streaming.snapshots.STATE_STORE", {})
        assert load("old", ("r1", one)) == (1, {False})
    assert load("new") == (1, {True})
    assert load("new", ("r2", one), ("r3", two)) == (2, {True})
    assert load("old") == (2, {False})
