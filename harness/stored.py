"""Tables of the lake written once per application and data folder from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harness import inputs
from harness.views import VIEWS, table
from skytally.operators.trigrams import TrigramIndex
from skytally.plans import jobs, runlog
from skytally.schemas import RUN_LOG
from skytally.session import scratch_path
from skytally.sources.tables import put
from skytally.streaming.snapshots import ingest

_built: dict[tuple[str, str, str], object] = {}


def _still_there(spark: SparkSession, built: object) -> bool:
    """Whether the folder a build names first has not been cleared away since."""
    while isinstance(built, (tuple, dict)):
        built = next(iter(built.values() if isinstance(built, dict) else built))
    if isinstance(built, DataFrame):
        found = built.inputFiles()
        folder = found[0] if found else ""
    else:
        folder = built.root if isinstance(built, jobs.Lake) else str(built)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder) if folder else None
    return path is None or path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def once(name: str, spark: SparkSession, sf_dir: str, build: Callable[[], object]) -> object:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built or not _still_there(spark, _built[key]):
        _built[key] = build()
    return _built[key]


def searchable_predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, TrigramIndex]:
    """v_pred stored by day, with the trigram index of its identifiers."""

    def build():
        path = scratch_path(spark, "predictions")
        rows = table(spark, sf_dir, "v_pred").withColumn("day", F.col("departure_scheduled").cast("date"))
        rows.write.partitionBy("day").parquet(path)
        index = TrigramIndex(f"{path}-trigrams", ("flight_iata", "flight_icao"), ("event_id",), "day")
        stored = spark.read.schema(rows.schema).parquet(path)
        half = F.col("event_id") % 2 == 0
        index.add(stored.where(half))
        index.add(stored.where(~half))
        return path, rows.schema, index

    path, schema, index = once("predictions", spark, sf_dir, build)
    return spark.read.schema(schema).parquet(path), index


def run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_obs as payload files: one per run and hour, records in order of event_id."""
    rows = inputs.document_text(spark, sf_dir).withColumn("hour", F.date_format("departure_scheduled", "HH"))
    held = F.array_sort(F.collect_list(F.struct("event_id", "text")))
    return rows.groupBy("run_id", "hour").agg(held.alias("held")).select(
        "run_id", F.concat(F.lit("flights_"), "run_id", F.lit("_"), "hour").alias("file_name"),
        F.concat(F.lit('{"data":['), F.array_join(F.transform("held", lambda h: h["text"]), ","), F.lit("]}")).alias("payload"))


def odd_day(run_id: str = "run_id") -> Column:
    return F.substring(run_id, -2, 2).cast("int") % 2 == 1


def route_lake(spark: SparkSession, sf_dir: str) -> jobs.Lake:
    """v_obs loaded by the routes job: runs of even days first, of odd days later."""

    def build():
        lake, files = jobs.Lake(scratch_path(spark, "lake")), run_files(spark, sf_dir)
        for seq, part in enumerate((files.where(~odd_day()), files.where(odd_day()))):
            jobs.routes_job(spark, lake, part, "aviationstack", "flights", seq)
        return lake

    return once("routes", spark, sf_dir, build)


def document_lake(spark: SparkSession, sf_dir: str) -> jobs.Lake:
    """v_obs loaded as documents, runs of even days first."""

    def build():
        lake, files = jobs.Lake(scratch_path(spark, "lake")), run_files(spark, sf_dir)
        for name, part in (("even", files.where(~odd_day())), ("odd", files.where(odd_day()))):
            jobs.load_documents(spark, lake, part, "flights", "aviationstack", name)
        return lake

    return once("documents", spark, sf_dir, build)


def poisoned_lake(spark: SparkSession, sf_dir: str) -> jobs.Lake:
    """v_obs as payload files of seven shapes, every thirteenth cut short, loaded twice as documents."""

    def build():
        lake = jobs.Lake(scratch_path(spark, "lake"))
        files = inputs.payloads(spark, sf_dir).select("event_id", "file_name", F.to_json("payload").alias("payload"))
        broken = F.expr("substr(payload, 1, length(payload) - 1)")
        files = files.withColumn("payload", F.when(F.col("event_id") % 13 == 0, broken).otherwise(F.col("payload")))
        for _ in range(2):
            jobs.load_documents(spark, lake, files, "flights", "aviationstack", "r1")
        return lake

    return once("poisoned", spark, sf_dir, build)


def evolved_table(spark: SparkSession, sf_dir: str) -> str:
    """v_obs by run, written by two loads: the later one has another column and wider delays."""

    def build():
        path = scratch_path(spark, "evolved")
        rows = table(spark, sf_dir, "v_obs").select("run_id", "event_id", "flight_iata", "departure_delay", "arrival_delay")
        narrow = rows.where(~odd_day()).drop("arrival_delay")
        put(narrow.withColumn("departure_delay", F.col("departure_delay").cast("int")), path, ("run_id",))
        put(rows.where(odd_day()).withColumn("departure_delay", F.col("departure_delay").cast("bigint")), path, ("run_id",))
        return path

    return once("evolved", spark, sf_dir, build)


COMPACTED_BEFORE, DROPPED = "2024-01-21", dict(source="aviationstack", endpoint="airports", stage="load_signup")


def kept_log(spark: SparkSession, sf_dir: str) -> str:
    """v_runs recorded in three loads, closed days compacted, one label group deleted."""

    def build():
        path = scratch_path(spark, "runs")
        runs = table(spark, sf_dir, "v_runs").withColumn("run_id", F.col("run_id").cast("string"))
        for third in range(3):
            runlog.record_runs(runs.where(F.col("run_id").cast("long") % 3 == third), path)
        runlog.compact(spark, path, RUN_LOG, COMPACTED_BEFORE)
        runlog.delete_runs(spark, path, **DROPPED)
        return path

    return once("runs", spark, sf_dir, build)


def replayed_lake(spark: SparkSession, sf_dir: str) -> jobs.Lake:
    """v_obs as a stream of payloads that all land twice, the second time under another name."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    stream.createOrReplaceTempView("streamed_events")
    observed = spark.sql(VIEWS["v_obs"].replace("FROM events", "FROM streamed_events"))
    landed = observed.withColumn("text", F.expr(inputs.DOCUMENT)).select(
        "run_id", F.concat(F.lit('{"data":['), "text", F.lit("]}")).alias("payload"),
        F.explode(F.array(*[F.concat("run_id", F.lit(f"-{copy}.json")) for copy in range(2)])).alias("file_name"))
    lake = jobs.Lake(scratch_path(spark, "lake"))
    ingest(lake, landed, "aviationstack", "flights", scratch_path(spark, "stream"), "2 days").awaitTermination()
    return lake
