"""Run log and the pipeline-health queries over it."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.schemas import RUN_EVENTS, RUN_LOG
from skytally.session import cut_lineage
from skytally.sources.tables import conform, drop_partition, put, read_table

LABELS = ["source", "endpoint", "stage"]


DAY = "day"  # partition below the labels; closed days can be compacted


def _by_day(rows: DataFrame, at: str) -> DataFrame:
    return rows.withColumn(DAY, F.date_format(F.col(at).cast("timestamp"), "yyyy-MM-dd"))


def record_runs(runs: DataFrame, path: str) -> None:
    """Append finished runs; one file per label group and day they touch."""
    put(_by_day(conform(runs, RUN_LOG), "finished_at"), path, (*LABELS, DAY), mode="append")


def record_run(
    spark: SparkSession, path: str, *, source: str, endpoint: str, stage: str, status: str,
    duration_seconds: float, records_processed: int | None = None, run_id: str | None = None,
    finished_at: datetime | None = None,
) -> None:
    """Append one finished run; labels are trimmed and lower-cased."""
    source, endpoint, stage, status = (
        v.strip().lower() for v in (source, endpoint, stage, status)
    )
    if status not in {"success", "failed"}:
        raise ValueError("unknown run status; use 'success' or 'failed'")
    row = (
        source, endpoint, stage, status, run_id, finished_at or datetime.now(timezone.utc),
        float(duration_seconds), records_processed,
    )
    record_runs(spark.createDataFrame([row], RUN_LOG), path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, RUN_LOG)


def _same_labels(source: str, endpoint: str, stage: str) -> Column:
    wanted = {"source": source, "endpoint": endpoint, "stage": stage}
    same = F.lit(True)
    for label, value in wanted.items():
        same = same & (F.col(label) == value.strip().lower())
    return same


def forget_runs(runs: DataFrame, *, source: str, endpoint: str, stage: str) -> DataFrame:
    """The log without one label group."""
    return runs.where(~_same_labels(source, endpoint, stage))


def delete_runs(spark: SparkSession, path: str, *, source: str, endpoint: str, stage: str) -> int:
    """Delete the folders of one label group from the stored log; returns how many."""
    rows = read_runs(spark, path).where(_same_labels(source, endpoint, stage))
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    # File paths are url-encoded; folders are found by name, whatever characters the labels have.
    folders = [r[0] for r in rows.select(F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))).distinct().collect()]
    for found in folders:
        drop_partition(spark, found)
    return len(folders)


def log_event(spark: SparkSession, path: str, level: str, stage: str, event: str, **details) -> None:
    row = (
        datetime.now(timezone.utc), level.upper(), stage, event,
        json.dumps(details, ensure_ascii=False, default=str),
    )
    put(_by_day(spark.createDataFrame([row], RUN_EVENTS), "timestamp"), path, (DAY,), mode="append")


def compact(spark: SparkSession, path: str, schema: T.StructType, before: str) -> None:
    """Rewrite the days before ``before`` (yyyy-MM-dd), so that each of their folders holds few files.

    Runs are recorded as they finish, a file each; no one appends to a day that is over, so its folders can be
    replaced whole. Folders that hold one file are left alone.
    """
    full = T.StructType([*schema, T.StructField(DAY, T.StringType())])
    labels = [c for c in LABELS if c in schema.names] if schema == RUN_LOG else []
    folders = [*labels, DAY]
    stored = read_table(spark, path, full)
    if stored.isEmpty():
        return
    closed = stored.where(F.col(DAY) < before)
    split = closed.groupBy(*folders).agg(F.count_distinct("_metadata.file_path").alias("files")).where("files > 1")
    put(cut_lineage(closed.join(split.drop("files"), folders, "left_semi").select(full.names)), path, tuple(folders))


def event_lines(events: DataFrame) -> DataFrame:
    """One JSON object per event."""
    return events.select(F.to_json(F.struct("*")).alias("value"))


def selected(runs: DataFrame, **patterns: str) -> DataFrame:
    """Keep runs whose labels match the given regexes as a whole."""
    for label, pattern in patterns.items():
        runs = runs.where(F.col(label).rlike(f"^(?:{pattern})$"))
    return runs


def gauges(runs: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """Last and highest values per label group; ``max_by`` combines before the shuffle."""
    ok = F.when(F.col("status") == "success", 1).otherwise(0)
    ties = ["run_id"] if "run_id" in runs.columns else []
    last = lambda c: F.max_by(c, F.struct("finished_at", *ties))
    return runs.groupBy(*labels).agg(
        last(ok).alias("last_status"),
        last("duration_seconds").alias("last_duration_seconds"),
        last("records_processed").alias("last_records_processed"),
        F.max(ok).alias("max_status"),
        F.max("duration_seconds").alias("max_duration_seconds"),
        F.max("records_processed").alias("max_records_processed"),
    )


def total_executions(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count(F.lit(1)).alias("executions"))


def failure_rate(runs: DataFrame) -> DataFrame:
    failed, total = F.count_if(F.col("status") == "failed"), F.count(F.lit(1))
    return runs.agg((100.0 * failed / F.greatest(total, F.lit(1))).alias("failure_rate"))


def executions_by_status(runs: DataFrame) -> DataFrame:
    return runs.groupBy("endpoint", "stage", "status").agg(F.count(F.lit(1)).alias("executions"))


def label_values(runs: DataFrame, label: str) -> DataFrame:
    return runs.select(label).distinct().orderBy(label)


# --- series over a time range ------------------------------------------------------------------

MAX_STEPS = 11_000


@dataclass(frozen=True)
class TimeRange:
    """Points from ``start`` to ``end`` (UTC where they name no zone), ``step_seconds`` apart."""

    start: datetime
    end: datetime
    step_seconds: int

    def __post_init__(self) -> None:
        if self.step_seconds <= 0 or self.micros(self.end) < self.micros(self.start):
            raise ValueError("a time range needs a positive step and an end that is not before its start")
        if self.steps >= MAX_STEPS:
            raise ValueError(f"a time range has at most {MAX_STEPS} points")

    @staticmethod
    def micros(at: datetime) -> int:
        at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
        since = at - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds

    @property
    def steps(self) -> int:
        return (self.micros(self.end) - self.micros(self.start)) // (self.step_seconds * 1_000_000)

    def step_of(self, at: Column) -> Column:
        """Number of the first point at or after a time; negative for times before the range."""
        past = F.unix_micros(at.cast("timestamp")) - self.micros(self.start)
        return F.ceil(past / (self.step_seconds * 1_000_000)).cast("int")

    def point(self, number: Column) -> Column:
        return F.timestamp_micros(number.cast("long") * (self.step_seconds * 1_000_000) + self.micros(self.start))

    def numbers(self, first: int = 0) -> Column:
        return F.explode(F.sequence(F.lit(first), F.lit(self.steps)) if self.steps >= first else F.array().cast("array<int>"))


def in_range(runs: DataFrame, over: TimeRange) -> DataFrame:
    """Runs that finished in the range; with :func:`gauges` the last and highest values over it."""
    at = F.unix_micros(F.col("finished_at").cast("timestamp"))
    return runs.where(at.between(over.micros(over.start), over.micros(over.end)))


def metric_series(runs: DataFrame, over: TimeRange, labels: list[str] = LABELS) -> DataFrame:
    """Status, duration and records of the last run at each point of the range, per label group.

    The last run counts from the point at or after its end until the next one, runs before the range too. Runs
    are reduced to one per group and step before the window, so it sorts at most the range's points.
    """
    values = ["status_value", "duration_seconds", "records_processed"]
    ok = F.when(F.col("status") == "success", 1).otherwise(0)
    ties = ["run_id"] if "run_id" in runs.columns else []
    step = F.greatest(over.step_of(F.col("finished_at")), F.lit(0))
    held = (
        runs.where("finished_at IS NOT NULL")
        .select(*labels, *ties, "finished_at", ok.alias("status_value"), *values[1:], step.alias("step"))
        .where(F.col("step") <= over.steps)
    )
    last = held.groupBy(*labels, "step").agg(
        F.max_by(F.struct(*values), F.struct("finished_at", *ties)).alias("seen"))
    grid = held.select(*labels).distinct().select(*labels, over.numbers().alias("step")).withColumn(
        "seen", F.lit(None).cast(last.schema["seen"].dataType))
    points = last.unionByName(grid).groupBy(*labels, "step").agg(F.first("seen", ignorenulls=True).alias("seen"))
    until = Window.partitionBy(*labels).orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = points.withColumn("seen", F.last("seen", ignorenulls=True).over(until)).where("seen IS NOT NULL")
    return carried.select(over.point(F.col("step")).alias("at"), *labels, *[F.col(f"seen.{v}").alias(v) for v in values])


def executions_by_step(
    runs: DataFrame, over: TimeRange, labels: tuple[str, ...] = ("endpoint", "stage", "status")
) -> DataFrame:
    """Runs that finished since the point before, per label group; zero where a group of the range had none."""
    step = over.step_of(F.col("finished_at"))
    held = runs.where("finished_at IS NOT NULL").select(*labels, step.alias("step")).where(
        F.col("step").between(1, over.steps))
    counted = held.groupBy(*labels, "step").agg(F.count(F.lit(1)).alias("n"))
    grid = counted.select(*labels).distinct().select(*labels, over.numbers(1).alias("step"), F.lit(0).cast("long").alias("n"))
    filled = counted.unionByName(grid).groupBy(*labels, "step").agg(F.sum("n").alias("executions"))
    return filled.select(over.point(F.col("step")).alias("at"), *labels, "executions")
