"""Substring search by stored trigram postings.

An index holds a row (gram, field, part, row) for each distinct trigram of each identifier field of a table:
``part`` is the table's partition, ``row`` a digest of the row's key. It lies in folders by a hash of the
trigram and is sorted by it, so a search opens the folders of its needle's trigrams and the row groups that
hold them, intersects the postings per field, and then reads only the table's partitions that have a
candidate. The exact condition is checked on the rows themselves. So postings may repeat, digests may
clash and postings of replaced rows may stay behind: they only add candidates. ``add`` therefore appends,
whatever was upserted or replayed, and ``compact`` puts the pieces together from time to time.

A needle without three characters in a row, or a table without an index, is searched by a full scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.operators.search import MASK_ID_COLUMNS, SQL_ID_COLUMNS, contains_text, like_any_id, quoted
from skytally.session import cut_lineage
from skytally.sources.table_schemas import keep_schema
from skytally.sources.tables import read_table, touched

GRAM = 3
FOLDERS = 64
MAX_GRAMS = 62  # a needle's trigrams are bits of a long; more would not narrow further


def folder_of(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(FOLDERS)).cast("int")


def trigrams(text: Column) -> Column:
    """Distinct trigrams of the lower-cased text; none of shorter texts and null."""
    lowered = F.lower(text)
    last = F.length(lowered) - (GRAM - 1)
    found = F.transform(F.sequence(F.lit(1), last), lambda at: F.substring(lowered, at, F.lit(GRAM)))
    return F.when(last >= 1, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def literal_parts(pattern: str) -> list[str]:
    """What a LIKE pattern demands literally, between its wildcards; a backslash quotes."""
    parts, at = [""], 0
    while at < len(pattern):
        if pattern[at] in "%_":
            parts.append("")
        else:
            at += pattern[at] == "\\" and at + 1 < len(pattern)
            parts[-1] += pattern[at]
        at += 1
    return [p for p in parts if p]


@dataclass(frozen=True)
class TrigramIndex:
    """Postings at ``path`` of ``fields`` of a table with row ``key`` and partition column ``part``."""

    path: str
    fields: tuple[str, ...]
    key: tuple[str, ...]
    part: str

    def row(self) -> Column:
        return F.xxhash64(*[quoted(k) for k in self.key])

    def stored(self, spark: SparkSession) -> DataFrame | None:
        return read_table(spark, self.path)

    def postings(self, rows: DataFrame) -> DataFrame:
        def named(field: str) -> Column:
            return F.transform(trigrams(quoted(field).cast("string")), lambda gram: F.struct(
                gram.alias("gram"), F.lit(field).alias("field")))

        grams = F.flatten(F.array(*[named(f) for f in self.fields]))
        return rows.select(
            quoted(self.part).cast("string").alias("part"), self.row().alias("row"), F.inline(grams)
        ).select("gram", "field", "part", "row", folder_of(F.col("gram")).alias("folder"))

    def _write(self, postings: DataFrame, mode: str) -> None:
        keep_schema(postings.sparkSession, self.path, postings.schema)
        # REBALANCE splits the folder of a frequent trigram over several files.
        (
            postings.hint("rebalance", F.col("folder"))
            .sortWithinPartitions("folder", "gram", "part")
            .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("folder").parquet(self.path)
        )

    def add(self, rows: DataFrame) -> None:
        """Postings of new or changed rows; adding rows again does no harm."""
        self._write(self.postings(rows).distinct(), "append")

    def keep_up(self, table: DataFrame, changed: DataFrame) -> None:
        """Postings of the changed rows; of the whole table where there is no index yet."""
        self.add(changed if self.stored(changed.sparkSession) is not None else table)

    def compact(self, spark: SparkSession) -> None:
        """Each posting once, in few files."""
        stored = self.stored(spark)
        if stored is not None:
            self._write(cut_lineage(stored.distinct()), "overwrite")

    def candidates(self, spark: SparkSession, needles: Iterable[str]) -> DataFrame | None:
        """(part, row) of rows with all trigrams of the needles in one field; None if a scan is needed."""
        stored = self.stored(spark)
        if stored is None:
            return None
        parts = spark.createDataFrame([(n,) for n in needles], "needle string")
        wanted = parts.select(F.explode(trigrams(F.col("needle"))).alias("gram")).distinct()
        found = wanted.select("gram", folder_of(F.col("gram")).alias("folder")).orderBy("gram").limit(MAX_GRAMS).collect()
        if not found:
            return None
        bit = F.lit(0).cast("long")
        for number, one in enumerate(found):
            bit = F.when(F.col("gram") == one["gram"], F.lit(1 << number)).otherwise(bit)
        return (
            stored.where(F.col("folder").isin(sorted({r["folder"] for r in found})))
            .where(F.col("gram").isin([r["gram"] for r in found]))
            .groupBy("part", "row", "field").agg(F.bit_or(bit).alias("bits"))
            .where(F.col("bits") == (1 << len(found)) - 1).select("part", "row").distinct()
        )

    def narrow(self, table: DataFrame, needles: Iterable[str]) -> DataFrame:
        """The table's rows that may contain the needles: all of them where the index cannot tell."""
        found = self.candidates(table.sparkSession, needles)
        if found is None:
            return table
        found = cut_lineage(found.withColumn("part", F.col("part").cast(table.schema[self.part].dataType)))
        near = touched(table, found.select(F.col("part").alias(self.part)), self.part)
        here = (quoted(self.part).eqNullSafe(F.col("_part"))) & (self.row() == F.col("_row"))
        return near.join(found.select(F.col("part").alias("_part"), F.col("row").alias("_row")), here, "left_semi")

    def covers(self, table: DataFrame, candidates: list[str]) -> bool:
        """Whether all columns of the table that a search looks at are indexed."""
        searched = {c for c in candidates if c in table.columns}
        return bool(searched) and searched <= set(self.fields)

    def like_any_id(self, table: DataFrame, text: str) -> DataFrame:
        """The rows of ``like_any_id``, found by the index."""
        narrowed = self.covers(table, SQL_ID_COLUMNS)
        return like_any_id(self.narrow(table, literal_parts(text.strip())) if narrowed else table, text)

    def contains_text(self, table: DataFrame, text: str) -> DataFrame:
        """The rows of ``contains_text``, found by the index."""
        narrowed = bool(text) and self.covers(table, MASK_ID_COLUMNS)
        return contains_text(self.narrow(table, [text.strip()]) if narrowed else table, text)
