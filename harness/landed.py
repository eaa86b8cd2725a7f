"""Files as they land, written from the views: payloads, flight CSVs and point CSVs under their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harness import inputs, stored
from harness.views import table
from skytally.operators.joins import spread_input
from skytally.session import scratch_path


RECORDS_PER_FILE, POINTS_PER_TASK = 20_000, 1_000_000


def place_files(spark: SparkSession, written: str, folder: str, name: str) -> None:
    """Rename the files of each ``key=…`` folder to ``name`` with the key and their number, below ``folder``."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    root = path_of(written)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path_of(folder))
    for part in files.listStatus(root):
        key = part.getPath().getName().partition("=")[2]
        if key:
            for number, one in enumerate(s for s in files.listStatus(part.getPath()) if s.getPath().getName().startswith("part-")):
                target = path_of(f"{folder}/{name.format(key=key, n=number)}")
                files.mkdirs(target.getParent())
                files.rename(one.getPath(), target)


def payload_files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The payloads of each run: raw files of all; as incoming files days 1 to 10, archived 11 to 20, renamed 21 to 25.

    A run of more than about RECORDS_PER_FILE records has several files of one name, in numbered folders. All
    places are written by one job, so the records are put together once.
    """

    def build():
        root = scratch_path(spark, "landed")
        rows = inputs.document_text(spark, sf_dir).select(F.col("run_id").alias("key"), "event_id", "text")
        pages = rows.groupBy(F.col("key").alias("_key")).agg(F.ceil(F.count(F.lit(1)) / RECORDS_PER_FILE).alias("pages"))
        dealt = rows.join(pages, F.col("key").eqNullSafe(F.col("_key"))).withColumn(
            "page", F.pmod(F.xxhash64("event_id"), "pages"))
        held = F.array_sort(F.collect_list(F.struct("event_id", "text")))
        runs = dealt.groupBy("key", "page").agg(held.alias("held")).select(
            "key", "page", F.concat(F.lit('{"data":['), F.array_join(F.transform("held", lambda h: h["text"]), ","), F.lit("]}")).alias("value"))
        day = F.substring("key", -2, 2).cast("int")
        parts: dict[str, tuple[Column, str, str]] = {
            "raw": (F.lit(True), "raw", "aviationstack_flights_raw_{key}.json"),
            "incoming": (day <= 10, "incoming", "aviationstack_flights_incoming_{key}.json"),
            "archived": (day.between(11, 20), "processed/old", "aviationstack_flights_incoming_{key}.json"),
            "renamed": (day.between(21, 25), "processed", "r7__aviationstack_flights_incoming_{key}.json"),
        }
        places = F.array_compact(F.array(*[F.when(which, F.lit(part)) for part, (which, _, _) in parts.items()]))
        written = f"{root}/tmp"
        runs.select("key", "value", F.explode(places).alias("place"), "page").write.partitionBy("place", "page", "key").text(written)
        path_of = spark._jvm.org.apache.hadoop.fs.Path
        files = path_of(written).getFileSystem(spark._jsc.hadoopConfiguration())
        for part, (_, folder, name) in parts.items():
            files.mkdirs(path_of(f"{root}/{folder}"))
            for one in files.globStatus(path_of(f"{written}/place={part}/page=*")):
                page = one.getPath().getName().partition("=")[2]
                place_files(spark, one.getPath().toString(), f"{root}/{folder}/{page}", name)
        return {"root": root, "raw": f"{root}/raw/*", "incoming": f"{root}/incoming/*", "processed": f"{root}/processed"}

    return stored.once("payload files", spark, sf_dir, build)


def flight_files(spark: SparkSession, sf_dir: str) -> str:
    """v_hist as flight CSVs, a folder per origin airport. A large airport is split over several tasks and files."""

    def build():
        root = scratch_path(spark, "history")
        flights = inputs.history_text(spark, sf_dir).withColumn("key", F.col("ADEP"))
        flights.hint("rebalance", F.col("key")).write.partitionBy("key").option("header", True).csv(f"{root}-f")
        place_files(spark, f"{root}-f", root, "{key}/Flights_{key}_{n}.csv")
        return root

    return stored.once("flight files", spark, sf_dir, build)


def point_files(spark: SparkSession, sf_dir: str) -> str:
    """v_points as point CSVs by sequence number, of at most POINTS_PER_TASK rows. Each task writes the numbers it meets."""

    def build():
        root = scratch_path(spark, "points")
        points = table(spark, sf_dir, "v_points").select(
            F.col("longitude").alias("Longitude"), F.col("latitude").alias("Latitude"), F.col("flight_id").alias("ECTRL ID"),
            F.col("sequence_number").alias("Sequence Number"), F.col("sequence_number").alias("key"))
        spread_input(points, POINTS_PER_TASK).write.partitionBy("key").option("header", True).csv(f"{root}-p")
        place_files(spark, f"{root}-p", root, "Flight_Points_Filed_{key}_{n}.csv")
        return root

    return stored.once("point files", spark, sf_dir, build)


def reference_payloads(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Airline or airport records as one payload file per run."""
    code, icao = ("airline_iata", "airline_iata") if kind == "airline" else ("departure_iata", "departure_icao")
    record = F.to_json(F.struct(
        F.nullif(F.col(code), F.lit("")).alias("iata_code"), F.concat(F.lit("Y"), F.col(icao)).alias("icao_code"),
        F.concat(F.lit("Name "), F.col(code)).alias(f"{kind}_name"), F.col("event_id").alias("seen"),
        F.when(F.col("event_id") % 3 == 0, F.col("flight_status")).alias("note")))
    rows = table(spark, sf_dir, "v_obs", spread=True).select("run_id", "event_id", record.alias("text"))
    held = F.array_sort(F.collect_list(F.struct("event_id", "text")))
    return rows.groupBy("run_id").agg(held.alias("held")).select(
        F.concat(F.lit("f"), "run_id").alias("file_name"), "run_id",
        F.concat(F.lit('[{"data":['), F.array_join(F.transform("held", lambda h: h["text"]), ","), F.lit("]},3]")).alias("payload"))
