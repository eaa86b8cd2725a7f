"""Exact stratified picks without a global or per-class sort."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skytally.operators.joins import with_computed

BUCKETS = 1 << 16
MAX_CLASSES = 1_000


def class_counts(df: DataFrame, label: str) -> dict[object, int]:
    """Rows per class (a handful of classes; checked)."""
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return {row[0]: row[1] for row in rows}


def pick_per_class(df: DataFrame, label: str, quota: dict[object, int], seed: int) -> DataFrame:
    """Add boolean ``picked``, true for exactly ``quota[class]`` seeded random rows of each class.

    A class without a quota gets none. A row's position is the hash of its content, so the pick does not depend on partitioning and a
    recomputed task picks the same rows. A histogram of the hash finds, per class, the bucket in
    which the quota runs out: rows below it are picked, rows above it are not, both without a
    shuffle. Only the boundary bucket (about 1/65,536 of a class) is ranked, after equal rows have
    been collapsed into a count, so neither a large class nor a mass of copies meets in one task.
    """
    if len(quota) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    columns = df.columns
    spark = df.sparkSession
    quotas = spark.createDataFrame(
        [(k, int(v)) for k, v in quota.items()],
        f"_class {df.schema[label].dataType.simpleString()}, _quota bigint",
    )
    draw = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns])
    rows = with_computed(df, {"_draw": draw}).withColumn("_bucket", F.pmod("_draw", F.lit(BUCKETS)))

    upto = W.partitionBy(label).orderBy("_bucket")  # at most BUCKETS rows per class
    histogram = (
        rows.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_through", F.sum("_n").over(upto))
        .join(F.broadcast(quotas), F.col(label).eqNullSafe(F.col("_class")))
    )
    boundary = histogram.where("_through > _quota").groupBy("_class").agg(
        F.min("_bucket").alias("_edge"),
        F.min_by(F.col("_quota") - (F.col("_through") - F.col("_n")), "_bucket").alias("_need"),
    )
    placed = rows.join(F.broadcast(boundary), F.col(label).eqNullSafe(F.col("_class")), "left")

    has_quota = F.col(label).isin([k for k in quota if k is not None])
    if None in quota:
        has_quota = has_quota | F.col(label).isNull()
    # A class with a quota but no edge is picked whole.
    settled = placed.where("_edge IS NULL OR _bucket <> _edge").select(
        *[F.col(f"`{c}`") for c in columns],
        F.coalesce(F.col("_bucket") < F.col("_edge"), has_quota, F.lit(False)).alias("picked"),
    )
    # Copies of one row are interchangeable: rank distinct rows, then hand out their copies.
    ranked = (
        placed.where("_bucket = _edge")
        .groupBy(*[F.col(f"`{c}`") for c in columns], "_draw", "_need")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn(
            "_before",
            F.sum("_copies").over(
                W.partitionBy(F.col(f"`{label}`"))
                .orderBy("_draw", *[F.col(f"`{c}`") for c in columns])
                .rowsBetween(W.unboundedPreceding, W.currentRow)
            ) - F.col("_copies"),
        )
        .withColumn("_take", F.least("_copies", F.greatest(F.col("_need") - F.col("_before"), F.lit(0))))
    )
    edge = ranked.select(
        *[F.col(f"`{c}`") for c in columns],
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"),
        "_take",
    ).withColumn("picked", F.col("_copy") <= F.col("_take")).drop("_copy", "_take")
    return settled.unionByName(edge)


def sample_quota(counts: dict[object, int], max_rows: int) -> dict[object, int]:
    """Rows to keep per class so that about ``max_rows`` remain in proportion."""
    total = sum(counts.values())
    return {k: min(n, max(1, int(max_rows * n / total))) for k, n in counts.items()}


def stratified_sample(df: DataFrame, label: str, max_rows: int, seed: int) -> DataFrame:
    counts = class_counts(df, label)
    if max_rows <= 0 or sum(counts.values()) <= max_rows:
        return df
    return pick_per_class(df, label, sample_quota(counts, max_rows), seed).where("picked").drop("picked")


def holdout_quota(counts: dict[object, int], test_share: float = 0.2) -> dict[object, int]:
    """Test rows per class: proportional, the rounding remainder to the largest fractions."""
    total = sum(counts.values())
    wanted = math.ceil(total * test_share)
    exact = {k: wanted * n / total for k, n in counts.items()}
    quota = {k: int(v) for k, v in exact.items()}
    short = wanted - sum(quota.values())
    for k in sorted(exact, key=lambda k: (quota[k] - exact[k], str(k)))[:short]:
        quota[k] += 1
    return quota


def split_train_test(
    df: DataFrame, label: str, test_share: float = 0.2, seed: int = 84
) -> tuple[DataFrame, DataFrame]:
    """Exact stratified split; unstratified when a class has fewer than two rows."""
    counts = class_counts(df, label)
    if len(counts) >= 2 and min(counts.values()) >= 2:
        marked = pick_per_class(df, label, holdout_quota(counts, test_share), seed)
    else:
        whole = df.withColumn("_all", F.lit(0))
        quota = {0: math.ceil(sum(counts.values()) * test_share)}
        marked = pick_per_class(whole, "_all", quota, seed).drop("_all")
    return marked.where("NOT picked").drop("picked"), marked.where("picked").drop("picked")


def bernoulli_sample(df: DataFrame, share: float = 0.2, seed: int = 84) -> DataFrame:
    return df.sample(withReplacement=False, fraction=share, seed=seed)
