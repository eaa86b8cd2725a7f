"""Structured Streaming ingest: each micro-batch of landed files feeds three keyed outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from skytally.operators.joins import spread_input
from skytally.plans import jobs
from skytally.sources.payloads import named_parts, payload_pattern, try_parsed


STATE = "spark.sql.streaming.stateStore"
# Where the digests of a stream are kept unless the session says otherwise: on the executors' disks, behind memory that
# does not grow with them. A checkpoint begun with another store goes on with that one.
STATE_STORE = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.maxMemoryUsageMB": "300",
}


def read_incoming(
    spark: SparkSession, folder: str, source: str, endpoint: str, files_per_batch: int = 1_000,
    archive: str | None = None,
) -> DataFrame:
    """Landed incoming files as a stream of (file_name, run_id, payload)."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", payload_pattern("incoming", source, endpoint))
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    text = reader.load(folder)
    return named_parts(
        text.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("payload"))
    )


def once_per_content(stream: DataFrame, remember: str = "2 days") -> DataFrame:
    """The stream without payloads whose text was seen before, under whatever file name.

    The digests seen are state of the stream's checkpoint, kept for ``remember`` after they were last put in
    by time of arrival; the time a file was written does not count, so old files are loaded as well. Of equal
    payloads that arrive together any one is kept.
    """
    keyed = stream.withColumns({
        "_content": F.sha2(F.coalesce("payload", F.lit("")), 256), "_seen_at": F.current_timestamp()})
    return keyed.withWatermark("_seen_at", remember).dropDuplicatesWithinWatermark(["_content"]).drop(
        "_content", "_seen_at")


def ingest(
    lake: jobs.Lake, stream: DataFrame, source: str, endpoint: str, checkpoint: str,
    remember: str | None = None,
) -> StreamingQuery:
    """Load everything a stream of (file_name, run_id, payload) holds by now, then stop.

    With ``remember`` a payload that lands again within that time, under another name, is not loaded again.

    Every output is keyed and the routes carry the batch number, so a batch that is replayed after a
    failure leaves the tables as they were. A file that is no JSON is set aside and does not stop the stream.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        held = try_parsed(spread_input(batch)).persist()  # parsed once for the three outputs
        try:
            jobs.load_documents(spark, lake, held, endpoint, source, f"stream-{batch_id}")
            jobs.fan_out(spark, lake, held.where("payload IS NOT NULL"), source, endpoint, batch_id)
        finally:
            held.unpersist()

    if remember:
        stream = once_per_content(stream, remember)
    writer = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return start_with(stream.sparkSession, STATE_STORE if remember else {}, writer)


def start_with(spark: SparkSession, settings: dict[str, str], writer: DataStreamWriter) -> StreamingQuery:
    """Start a query that takes the ``settings`` the session does not make itself; the session stays as it was."""
    added = {k: v for k, v in settings.items() if spark.conf.get(k, None) is None}
    for name, value in added.items():
        spark.conf.set(name, value)
    try:
        return writer.start()  # the query works on a copy of the session's settings
    finally:
        for name in added:
            spark.conf.unset(name)
