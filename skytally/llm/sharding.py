"""Sharding: best-fit-decreasing packing of indivisible groups into a fixed number of shards.

Equal texts form a group that stays in one shard. Shards have a common capacity; groups enter in
falling order of size, each the tightest shard that still has room, found by binary search in a list
sorted by remaining room. The smallest capacity at which all groups fit into the given number of
shards is found by bisection, so shard sizes come out near equal.

At scale the groups cannot all be placed one by one. The large ones (above ``1 / PIECES`` of a
shard) are at most ``shards * PIECES`` and are placed singly; the small ones are first dealt by the
hash of their text into ``shards * PIECES`` bundles, which are placed like groups. So the driver
places at most ``2 * shards * PIECES`` items and a few pieces, whatever the input. A group larger
than a shard cannot be kept whole with shards near equal in size; it alone is split, by the hash of
its rows' ids, into pieces of about half a shard.

Slots are gapless: rows are numbered within (shard, cell), cells being hash cells of the id, and the
cells' counts are summed up per shard, so no task holds a whole shard.

Cases: a null text has no bytes, size 8 and the crc32 of no bytes, and forms one group with the
empty text; repeated rows are placed each; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytally.llm.registry import read, register

PIECES = 200
PIECE_SHARE = 0.5
OVERHEAD = 8
CELL_ROWS = 100_000
MIN_CELLS = 64


def best_fit_decreasing(items: list[tuple[int, str]], capacity: float, shards: int) -> dict[str, int] | None:
    """Shard of each (size, name) item, or None when they need more than ``shards`` shards."""
    room = [(capacity, shard) for shard in range(shards)]  # sorted by room, then shard
    placed: dict[str, int] = {}
    for size, name in sorted(items, key=lambda item: (-item[0], item[1])):
        at = bisect.bisect_left(room, (size, -1))
        if at == len(room):
            return None
        left, shard = room.pop(at)
        placed[name] = shard
        bisect.insort(room, (left - size, shard))
    return placed


def smallest_capacity(items: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Best fit decreasing at the smallest capacity, to 1 / 4096 of the mean, at which it succeeds."""
    total, largest = sum(s for s, _ in items), max(s for s, _ in items)
    low = max(total / shards, largest)
    step = max(low / 4096, 1.0)
    most = 0
    while best_fit_decreasing(items, low + step * (2 ** most - 1), shards) is None:
        most += 1
    fails, works = (2 ** (most - 1) - 1 if most else -1), 2 ** most - 1
    while works - fails > 1:
        middle = (works + fails) // 2
        if best_fit_decreasing(items, low + step * middle, shards) is None:
            fails = middle
        else:
            works = middle
    return best_fit_decreasing(items, low + step * works, shards)


def _bucket(key: Column, count: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(count))


def shard_documents(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, group (digest of the text) and shard of each row."""
    spark = docs.sparkSession
    t = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"), (F.length(t) + OVERHEAD).cast("long").alias("size"),
        F.crc32(t).alias("text_crc32"), F.unhex(F.md5(t)).alias("group"))
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    shard_bytes = total / shards
    large = groups.filter(F.col("bytes") > shard_bytes / PIECES)
    bundles = shards * PIECES
    small = (groups.filter(F.col("bytes") <= shard_bytes / PIECES)
             .groupBy(_bucket(F.col("group"), bundles).alias("bundle")).agg(F.sum("bytes").alias("bytes")))
    # A split group's rows are equal texts, so equal counts are equal bytes.
    parts = F.when(F.col("bytes") <= shard_bytes, 1).otherwise(
        F.ceil(F.col("bytes") / max(shard_bytes * PIECE_SHARE, 1.0)).cast("int"))
    pieces = large.select("group", parts.alias("parts"))
    whole = rows.join(F.broadcast(pieces), "group", "left") if total else rows.withColumn("parts", F.lit(1))
    item = F.when(F.col("parts").isNull(), F.concat(F.lit("b"), _bucket(F.col("group"), bundles))).otherwise(
        F.concat(F.lit("g"), F.hex("group"), F.lit("/"), _bucket(F.col("doc_id"), F.col("parts"))))
    whole = whole.withColumn("item", item)
    # Both lists are bounded by shards * PIECES; a split group adds its pieces.
    items = [(r["bytes"], f"b{r['bundle']}") for r in small.collect()]
    split = whole.filter("parts is not null").groupBy("item").agg(F.sum("size").alias("bytes"))
    items += [(r["bytes"], r["item"]) for r in split.collect()]
    placed = smallest_capacity(items, shards) if items else {}
    places = spark.createDataFrame(sorted(placed.items()), "item string, shard int")
    return whole.join(F.broadcast(places), "item").select("doc_id", "size", "text_crc32", "group", "shard")


def with_slots(rows: DataFrame, cells: int) -> DataFrame:
    """``rows`` (doc_id, shard, …) with a gapless ``slot`` from 0 in each shard."""
    rows = rows.withColumn("cell", _bucket(F.col("doc_id"), cells))
    counts = rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    starts = counts.select("shard", "cell", before.alias("start"))
    number = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32"))
    numbered = rows.withColumn("number", number.cast("long"))
    return numbered.join(starts, ["shard", "cell"]).withColumn(
        "slot", F.col("start") + F.col("number") - 1).drop("cell", "number", "start")


@register("op4_shard_best_fit")
def op4_shard_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``bytes``: sizes near equal over shards 0 to 23."""
    docs = read(spark, sf_dir, "documents")
    placed = shard_documents(docs, 24)
    cells = max(MIN_CELLS, docs.count() // (24 * CELL_ROWS))
    return with_slots(placed, cells).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
