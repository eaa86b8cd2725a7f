"""Query registry: each Spark query with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: bigint, double rounded to 6 places, text, boolean."""
    columns = []
    for field in df.schema:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        columns.append(c.alias(field.name))
    return df.select(columns)


def query(name: str, oracle: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(fn(spark, sf_dir))

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = with_views(oracle, *views) if views else oracle
        return run

    return register


def stamp(column: str) -> str:
    """DuckDB text of a timestamp, as ``portable`` prints it."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
