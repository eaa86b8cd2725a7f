"""Keyed upserts.

Both merges are one union and one aggregation on the key. ``max_by`` combines on the map side, so a
key that holds a large part of the batch reaches its reducer as one row per map task; no window
sorts it and no join pairs it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TOP_LEVEL_FIELDS = 2_000


def top_level_fields(docs: DataFrame, column: str = "doc") -> list[str]:
    """Names of the top-level fields of the batch: schema discovery, one narrow pass."""
    names = (
        docs.select(F.explode(F.map_keys(F.try_variant_get(column, F.lit("$"), "map<string,variant>"))))
        .distinct()
        .limit(MAX_TOP_LEVEL_FIELDS + 1)
        .collect()
    )
    if len(names) > MAX_TOP_LEVEL_FIELDS:
        raise ValueError("documents have too many distinct top-level fields for one table")
    return sorted(row[0] for row in names)


def spread_fields(docs: DataFrame, fields: Sequence[str], column: str = "doc") -> DataFrame:
    """One VARIANT column per top-level field: SQL NULL is absent, variant null is a JSON null."""
    rest = [c for c in docs.columns if c != column]
    as_map = F.try_variant_get(column, F.lit("$"), "map<string,variant>")
    spread = docs.select(*rest, as_map.alias("_fields"))
    return spread.select(
        *rest, *[F.try_element_at("_fields", F.lit(f)).alias(f) for f in fields]
    )


def _content_hash(fields: Sequence[str]) -> Column:
    """Hash of the present fields with their names; absent fields do not take part."""
    if not fields:
        return F.lit(0).cast("long")
    return F.xxhash64(F.to_json(F.struct(*[F.col(f"`{f}`") for f in sorted(fields)])))


def merge_documents(
    existing: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ignore: Sequence[str] = ("_meta",),
) -> DataFrame:
    """Field-level upsert with null-safe keys.

    Every non-key column is a field; a field that is SQL NULL in a row is absent there and keeps its
    older value. Within the batch the last row by ``order`` wins, per field. ``change_type`` is
    inserted, updated, unchanged or kept (not in the batch); ``ignore`` fields do not count as a
    change. ``batch_rows`` is the number of batch rows folded into the row.
    """
    keys, order = list(keys), list(order)
    new_fields = [c for c in batch.columns if c not in keys + order]
    old_fields = [] if existing is None else [c for c in existing.columns if c not in keys]
    fields = new_fields + [c for c in old_fields if c not in new_fields]

    fresh = batch.select(
        *keys, *new_fields, F.lit(1).alias("_side"), F.struct(*order).alias("_order")
    )
    both = fresh
    if existing is not None:
        stored = existing.select(
            *keys, *old_fields, F.lit(0).alias("_side"),
            F.lit(None).cast(fresh.schema["_order"].dataType).alias("_order"),
            _content_hash([f for f in old_fields if f not in ignore]).alias("_old_hash"),
        )
        both = stored.unionByName(fresh, allowMissingColumns=True)
    else:
        both = both.withColumn("_old_hash", F.lit(None).cast("long"))

    rank = F.struct("_side", "_order")
    latest = [
        F.max_by(f"`{f}`", F.when(F.col(f"`{f}`").isNotNull(), rank)).alias(f) for f in fields
    ]
    merged = both.groupBy(*keys).agg(
        *latest,
        F.max("_old_hash").alias("_old_hash"),
        F.min("_side").alias("_first_side"),
        F.sum("_side").alias("batch_rows"),
    )
    new_hash = _content_hash([f for f in fields if f not in ignore])
    return merged.withColumn(
        "change_type",
        F.when(F.col("batch_rows") == 0, "kept")
        .when(F.col("_first_side") == 1, "inserted")
        .when(F.col("_old_hash") == new_hash, "unchanged")
        .otherwise("updated"),
    ).drop("_old_hash", "_first_side")


def merge_relational(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    keep_first: Sequence[str] = ("created_at",),
) -> DataFrame:
    """Row-level upsert with SQL key equality: a row with a null in its key never conflicts.

    The last batch row by ``order`` replaces the stored one; ``keep_first`` columns keep the value
    of the first row of the key.
    """
    keys, order = list(keys), list(order)
    columns = [c for c in existing.columns]
    first = [c for c in keep_first if c in columns]
    values = [c for c in columns if c not in keys + first]
    extra = [c for c in order if c not in columns]

    fresh = batch.select(*columns, *extra, F.lit(1).alias("_side"))
    both = existing.withColumn("_side", F.lit(0)).unionByName(fresh, allowMissingColumns=True)

    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    rank = F.struct("_side", *order)
    merged = both.where(~null_key).groupBy(*keys).agg(
        F.max_by(F.struct(*values), rank).alias("_row"),
        *[F.min_by(c, rank).alias(c) for c in first],
    )
    conflicting = merged.select(
        [F.col(f"_row.{c}").alias(c) if c in values else F.col(c) for c in columns]
    )
    return conflicting.unionByName(both.where(null_key).select(columns))


def change_counters(merged: DataFrame) -> DataFrame:
    """Inserted, updated, unchanged and folded rows of one document merge."""
    kind = F.col("change_type")
    touched = F.count_if(kind != "kept")
    return merged.agg(
        F.coalesce(F.sum("batch_rows"), F.lit(0)).alias("valid"),
        F.count_if(kind == "inserted").alias("inserted"),
        F.count_if(kind == "updated").alias("updated"),
        F.count_if(kind == "unchanged").alias("unchanged"),
        (F.coalesce(F.sum("batch_rows"), F.lit(0)) - touched).alias("folded"),
    )


def record_counters(keyed: DataFrame) -> DataFrame:
    """Records, valid and invalid per file."""
    return keyed.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
    )
