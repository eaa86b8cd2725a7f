import json

import pytest
from pyspark.sql import functions as F

from skytally.sources import csv_files, payloads, tables


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content))


def test_scan_and_promote_keep_content(spark, tmp_path):
    for n in (2, 1):
        put(tmp_path, f"aviationstack_flights_raw_r{n}.json", {"data": [{"n": n}], "é": "\n"})
    put(tmp_path, "aviationstack_airports_raw_r1.json", {})
    raw = payloads.scan_raw(spark, str(tmp_path), " Aviationstack ", "FLIGHTS")
    incoming = payloads.promote_to_incoming(raw).orderBy("file_name").collect()
    assert [r.file_name for r in incoming] == [
        "aviationstack_flights_incoming_r1.json", "aviationstack_flights_incoming_r2.json"]
    assert json.loads(incoming[1].payload) == {"data": [{"n": 2}], "é": "\n"}
    assert [(r.source, r.endpoint, r.run_id) for r in incoming][0] == ("aviationstack", "flights", "r1")
    assert payloads.scan_raw(spark, str(tmp_path), "aviationstack", "flights", "r2").count() == 1


def test_scan_raw_without_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        payloads.scan_raw(spark, str(tmp_path), "aviationstack", "flights")
    with pytest.raises(FileNotFoundError):
        payloads.scan_raw(spark, str(tmp_path / "absent"), "aviationstack", "flights")


def test_discover_falls_back_to_any_run(spark, tmp_path):
    put(tmp_path, "aviationstack_flights_incoming_old.json", [])
    files, fell_back = payloads.discover_incoming(spark, str(tmp_path), "aviationstack", "flights", "new")
    assert fell_back and files.first().run_id == "old"
    _, fell_back = payloads.discover_incoming(spark, str(tmp_path), "aviationstack", "flights", "old")
    assert not fell_back


def test_snapshot_search_order(spark, tmp_path):
    incoming, processed = tmp_path / "in", tmp_path / "done"
    find = lambda: [
        r.file_name for r in payloads.find_snapshot_files(
            spark, str(incoming), str(processed), "aviationstack", "flights", "r1").collect()]
    incoming.mkdir(), processed.mkdir()
    with pytest.raises(FileNotFoundError):
        find()
    name = "aviationstack_flights_incoming_r1.json"
    for folder, file in [
        (processed, "note_r1.txt"), (processed / "deep", "x_r1_y.json"), (incoming, "a_r1_b.json"),
        (processed / "deep", f"q__{name}"), (processed / "deep", name), (incoming, name),
    ]:
        put(folder, file, [])
        assert find() == [file]


def test_pages_are_concatenated(spark):
    pages = spark.createDataFrame(
        [("p1", '{"data":[{"a":1},{"a":2}]}'), ("p2", '{"error":1}'), ("p3", '{"data":[{"a":3}]}')],
        "file_name string, text string").select("file_name", F.parse_json("text").alias("payload"))
    items = payloads.combine_pages(pages)
    assert items.count() == 3
    assert payloads.page_totals(items).first().asDict() == {"limit": 3, "offset": 0, "count": 3, "total": 3}


def test_bronze_write_replaces_a_run(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for payload in ({"data": [1]}, {"data": [2]}):
        payloads.write_raw(payloads.bronze_row(spark, payload, "S ", "Flights", "r1"), path)
    payloads.write_raw(payloads.bronze_row(spark, [], "s", "flights", "r2"), path)
    rows = spark.read.parquet(path).orderBy("run_id").collect()
    assert [(r.source, r.run_id, r.payload) for r in rows] == [("s", "r1", '{"data": [2]}'), ("s", "r2", "[]")]
    assert rows[0].file_name == "s_flights_raw_r1.json"


def test_ledger_excludes_processed(spark):
    files = spark.createDataFrame([("a.json",), ("b.json",)], "file_name string")
    ledger = payloads.ledger_rows(files.limit(1), "run")
    assert ledger.first().archived_name == "run__a.json"
    assert [r[0] for r in payloads.unprocessed(files, ledger).collect()] == ["b.json"]


def test_history_encodings_headers_and_rejects(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "Flights_1.csv").write_bytes("﻿ADEP, ADES ,Op\nLFPG,LFBO,Société\n".encode())
    (tmp_path / "Flights_2.csv").write_bytes("ADEP,ADES,Op,Extra\nLFPO,LFML,Été,1\n".encode("latin1"))
    (tmp_path / "Flights_3.csv").write_text("ADEP,Op\nLFPO,x\n")
    (tmp_path / "Flight_Points_Filed_1.csv").write_text(
        "ECTRL ID,Sequence Number,Time Over,Latitude,Longitude\n1,0,x,48.5,2.5\n1,1,x,bad,2\n")
    rows, rejected = csv_files.scan_history(spark, str(tmp_path), ["ADEP", "ADES"])
    got = {r["Op"]: (r["ADEP"], r["ADES"], r["Extra"]) for r in rows.collect()}
    assert got == {"Société": ("LFPG", "LFBO", None), "Été": ("LFPO", "LFML", "1")}
    assert [(k.rsplit("/", 1)[1], v) for k, v in rejected.items()] == [("Flights_3.csv", ["ADES"])]
    points = csv_files.scan_points(spark, str(tmp_path)).orderBy("Sequence Number").collect()
    assert [p["Latitude"] for p in points] == [48.5, None]


def test_points_of_files_with_other_column_order(spark, tmp_path):
    put(tmp_path, "Flight_Points_Filed_1.csv", "ECTRL ID,Sequence Number,Latitude,Longitude\n5,0,48.5,2.5\n")
    put(tmp_path, "Flight_Points_Filed_2.csv", "Sequence Number,ECTRL ID,Longitude,Latitude\n2,6,7.5,41\n")
    rows = csv_files.scan_points(spark, str(tmp_path)).orderBy("ECTRL ID").collect()
    assert [tuple(r) for r in rows] == [(5, 0, 48.5, 2.5), (6, 2, 41.0, 7.5)]
    assert csv_files.scan_points(spark, str(tmp_path / "none")).isEmpty()


def test_airport_coordinates_first_mapping_wins(spark, tmp_path):
    put(tmp_path, "airports.csv", (
        "ident,iso_country, iata_code,icao_code,gps_code,latitude_deg,longitude_deg\n"
        "LFPG,FR,CDG,LFPG,LFPG,49,2\n"
        "XX,FR,cdg,LFXX,,1,1\n"
        "LFNO,FR,,LFNO,,5,5\n"
        "EGLL,GB,LHR,EGLL,EGLL,51,0\n"
        "LFBAD,FR,BAD,LFBD,,x,1\n"))
    coords = csv_files.airport_coordinates(csv_files.scan_airports(spark, str(tmp_path / "airports.csv")))
    assert {r.code: (r.latitude, r.longitude) for r in coords.collect()} == {
        "CDG": (49.0, 2.0), "LFPG": (49.0, 2.0), "XX": (1.0, 1.0), "LFXX": (1.0, 1.0)}
    missing = csv_files.scan_airports(spark, str(tmp_path / "absent.csv"))
    assert csv_files.airport_coordinates(missing).isEmpty()


def test_append_csv_is_idempotent_per_file(spark, tmp_path):
    put(tmp_path, "x.csv", "a, b\n1,\n2,3\n")
    table = str(tmp_path / "t")
    assert tables.append_csv(spark, str(tmp_path / "x.csv"), table) == 2
    assert tables.append_csv(spark, str(tmp_path / "x.csv"), table) == 2
    assert spark.read.parquet(table).count() == 2
    put(tmp_path, "empty.csv", "")
    with pytest.raises(ValueError):
        tables.append_csv(spark, str(tmp_path / "empty.csv"), table)
    with pytest.raises(ValueError):
        tables.append_csv(spark, str(tmp_path / "x.txt"), table)


def test_touched_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50).select("id", (F.col("id") % 5).cast("string").alias("p")).write.partitionBy("p").parquet(path)
    table = spark.read.schema("id bigint, p string").parquet(path)
    batch = spark.createDataFrame([("1",), ("3",), (None,)], "p string")
    few = tables.touched(table, batch, "p")
    assert few.count() == 20 and "PartitionFilters: [(p" in few._jdf.queryExecution().executedPlan().toString()
    assert tables.touched(table, batch, "p", max_values=1).count() == 20


def test_recent_and_first_documents(spark):
    table = spark.createDataFrame([("a", "2024-01-02"), ("b", "2024-01-03"), ("c", None)], "k string, flight_date string")
    assert [r.k for r in tables.scan_recent(table, 2).collect()] == ["b", "a"]
    assert tables.scan_recent(table).count() == 3
    assert [r.k for r in tables.scan_documents(table, 1, ["k"]).collect()] == ["a"]
    with pytest.raises(ValueError):
        tables.scan_training(table, ["k", "absent"])


def test_ensure_table(spark, tmp_path):
    from skytally.schemas import SNAPSHOT_INSIGHTS
    path = str(tmp_path / "s")
    assert tables.ensure_table(spark, path, SNAPSHOT_INSIGHTS).schema.fieldNames() == SNAPSHOT_INSIGHTS.fieldNames()
    assert tables.ensure_table(spark, path, SNAPSHOT_INSIGHTS).count() == 0
