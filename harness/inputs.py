"""Reference-shaped inputs built from the views: documents, payloads, history text, run halves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.views import table
from skytally.functions.records import unwrap

# Payload shapes, chosen by event_id % 7 in ``payloads``.
SHAPES = {
    0: '{{"data":[{d}]}}',
    1: '{{"results":[{d},"junk"]}}',
    2: "[{d},{d},5]",
    3: "{d}",
    4: '"invalid"',
    5: "{{}}",
    6: '[{{"data":[{d},{d}]}},{{"results":[{d}]}},{d},7]',
}

DOCUMENT = """
to_json(named_struct(
  'flight_date', CAST(CAST(departure_scheduled AS DATE) AS STRING),
  'flight_status', flight_status,
  'flight', named_struct('iata', flight_iata, 'icao', 'X' || flight_iata, 'number', substr(flight_iata, 2)),
  'airline', named_struct('iata', airline_iata, 'name', 'Line ' || airline_iata),
  'departure', named_struct('iata', departure_iata, 'icao', departure_icao, 'timezone', departure_timezone,
     'scheduled', date_format(departure_scheduled, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
     'delay', CASE WHEN event_id % 6 = 2 THEN CAST(CAST(departure_delay AS STRING) AS VARIANT)
                   ELSE CAST(departure_delay AS VARIANT) END),
  'arrival', named_struct('iata', arrival_iata, 'timezone', arrival_timezone, 'delay', arrival_delay),
  'live', CASE WHEN live_is_ground IS NOT NULL THEN named_struct('is_ground', live_is_ground) END))
"""


def document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, run_id, flight columns and the JSON text of each observation."""
    return table(spark, sf_dir, "v_obs", spread=True).withColumn("text", F.expr(DOCUMENT))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, run_id, source, endpoint and the record as VARIANT in ``doc``."""
    payload = F.parse_json(F.concat(F.lit('{"data":['), F.col("text"), F.lit("]}")))
    files = document_text(spark, sf_dir).select(
        "event_id", "run_id", F.lit("aviationstack").alias("source"),
        F.lit("flights").alias("endpoint"), payload.alias("payload"),
    )
    return unwrap(files, "insights").drop("record_ix")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation as the payload of one file, in one of seven shapes."""
    shape = F.col("event_id") % 7
    text = F.lit(None).cast("string")
    for number, template in SHAPES.items():
        pieces = template.replace("{{", "{").replace("}}", "}").split("{d}")
        joined = [F.lit(pieces[0])]
        for piece in pieces[1:]:
            joined += [F.col("text"), F.lit(piece)]
        text = F.when(shape == number, F.concat(*joined)).otherwise(text)
    return document_text(spark, sf_dir).select(
        "event_id", "run_id", shape.alias("shape"),
        F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("file_name"),
        F.parse_json(text).alias("payload"),
    )


def history_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_hist as the text columns a flight CSV holds, '' where unknown."""
    fmt = "dd-MM-yyyy HH:mm:ss"
    hist = table(spark, sf_dir, "v_hist", spread=True)
    filed = F.col("filed_dep").cast("timestamp")
    actual = F.timestamp_add("MINUTE", F.col("delay_minutes"), filed)
    text = lambda c: F.col(c).cast("string")
    return hist.select(
        text("flight_id").alias("ECTRL ID"),
        F.col("origin").alias("ADEP"), F.col("destination").alias("ADES"),
        text("adep_lat").alias("ADEP Latitude"), text("adep_lon").alias("ADEP Longitude"),
        text("ades_lat").alias("ADES Latitude"), text("ades_lon").alias("ADES Longitude"),
        F.date_format(filed, fmt).alias("FILED OFF BLOCK TIME"),
        F.coalesce(F.date_format(actual, fmt), F.lit("")).alias("ACTUAL OFF BLOCK TIME"),
        F.col("aircraft_type").alias("AC Type"),
        F.concat(F.lit(" "), F.lower("operator")).alias("AC Operator"),
        text("requested_fl").alias("Requested FL"),
        text("requested_fl").alias("Actual Distance Flown (nm)"),
        F.coalesce(text("delay_minutes"), F.lit("")).alias("departure_delay_min"),
    )


def typed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_hist with the columns the punctuality report reads."""
    return table(spark, sf_dir, "v_hist").select(
        "flight_id", "operator", "aircraft_type", "origin", "destination",
        F.col("filed_dep").cast("timestamp").alias("filed_dep_time"),
        F.col("delay_minutes").cast("double").alias("delay_minutes"),
        (F.col("delay_minutes") > 15).alias("is_delayed"),
    )
