"""Whitening of embedding vectors with distributed block matrices.

A vector's entries c become integers ``floor(64 c) + 1000000``; each distinct integer vector counts once in
the fit list. Its rows are written, centred exactly on integers, indexed by file and place in the file,
and made a BlockMatrix of row blocks. The scatter is that matrix transposed times itself, in splits of
``SPLIT_BLOCKS`` blocks whose products are summed up; only the square scatter comes to the driver, where
``eigh`` gives the components. A second product with the whitening matrix projects all rows.

All rows of the table then look up their projection by a 128-bit digest of the integer vector. A vector
that fills more than a thousandth of the table is looked up in several copies, so no task takes it whole;
there are fewer than a thousand such vectors, so their list is broadcast.

Cases: vectors that are null, empty or hold a null or non-finite entry are left out; so are those whose
length is not the most frequent one (of equally frequent ones the greater). Entries beyond ``LIMIT`` / 64
count as that. Components whose variance is below ``NO_VARIANCE`` of the first's, rounding noise, are not
returned, so a table of one vector, or none, gives no rows. Repeated rows and rows without vec_id are
kept. ``deviation`` is null where 64 bits do not hold it. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytally.llm.registry import read, register
from skytally.session import cut_lineage

COMPONENTS = 16
STEPS, SHIFT = 64, 1_000_000
LIMIT = 1e12
BLOCK_BYTES = 4 << 20
SPLIT_BLOCKS = 16
NO_VARIANCE = 1e-12
HOT_ROWS = 100_000

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def integer_rows(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and the integer vector x of each row with a usable vector."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    usable = (F.size(entries) > 0) & F.forall(
        entries, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    step = lambda c: F.floor(F.greatest(F.least(c * STEPS, F.lit(LIMIT)), F.lit(-LIMIT))) + SHIFT
    x = F.transform(entries, step).cast("array<long>")
    return rows.filter(F.coalesce(usable, F.lit(False))).select(F.col(f"`{key}`").cast("long").alias("vec_id"), x.alias("x"))


def digest() -> list[Column]:
    """128 bits of x, as a and b."""
    return [F.xxhash64("x").alias("a"), F.xxhash64(F.lit(1), "x").alias("b")]


def fit_list(rows: DataFrame) -> tuple[DataFrame, int]:
    """The distinct vectors of the most frequent length, with copies and a gapless ``index``, and that length."""
    held = cut_lineage(rows.groupBy("x").agg(F.count("*").alias("copies")))
    lengths = held.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if top is None:
        return held, 0
    placed = held.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    sizes = placed.groupBy("file").agg((F.max("row") + 1).alias("rows"))
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sizes.select("file", (F.sum("rows").over(order) - F.col("rows")).alias("first"))
    indexed = placed.filter(F.size("x") == top["d"]).join(starts, "file")
    return indexed.withColumn("index", F.col("first") + F.col("row")).drop("file", "row", "first"), top["d"]


def deviations(u: Column, n: int, rest: list[int], widest: int) -> Column:
    """Sum over dimensions of (n u - rest)^2, exact; u = x - S div n and rest = S mod n."""
    wide = "decimal(38,0)"
    # The two sums over a row stay in long where their bound allows.
    kind = "long" if len(rest) * widest * max(n, widest) < 1 << 62 else wide
    total = lambda terms: F.aggregate(terms, F.lit(0).cast(kind), lambda a, t: (a + t).cast(kind)).cast(wide)
    squares = total(F.transform(u, lambda v: F.try_multiply(v.cast(kind), v.cast(kind)).cast(kind)))
    crossed = total(F.zip_with(u, F.lit(rest).cast(f"array<{kind}>"),
                               lambda v, r: F.try_multiply(v.cast(kind), r).cast(kind)))
    # n^2 squares - 2 n crossed + steady
    count, steady = F.lit(n).cast(wide), F.lit(str(sum(r * r for r in rest))).cast(wide)
    inner = F.try_subtract(F.try_multiply(squares, count), F.try_multiply(crossed, F.lit(2).cast(wide)))
    return F.try_add(F.try_multiply(inner.cast(wide), count).cast(wide), steady).try_cast("long")


def product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left times right, with the inner dimension dealt over ``splits`` tasks a result block."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def components(scatter: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Variances, their shares and unit components as columns, by falling variance."""
    covariance = (scatter + scatter.T) / (2 * n)
    variance, vectors = np.linalg.eigh(covariance)
    variance, vectors = variance[::-1], vectors[:, ::-1]
    kept = int(np.sum(variance > NO_VARIANCE * max(variance[0], 0))) if variance[0] > 0 else 0
    kept = min(kept, most)
    vectors = vectors[:, :kept]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, np.arange(kept)] < 0, -1.0, 1.0)
    return variance[:kept], variance[:kept] / np.trace(covariance), vectors


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    coded = integer_rows(rows, key, vector)
    fit, d = fit_list(coded)
    nothing = spark.createDataFrame([], RESULT)
    if not d:
        return nothing
    at = [F.element_at("x", i + 1) for i in range(d)]
    facts = fit.agg(F.count("*").alias("n"), F.sum("copies").alias("rows"), F.max("index").alias("last"),
                    F.array(*[F.sum(c.cast("decimal(38,0)")) for c in at]).alias("sums"),
                    F.max(F.array_max("x")).alias("high"), F.min(F.array_min("x")).alias("low")).first()
    n, sums = facts["n"], [int(s) for s in facts["sums"]]
    whole, rest = [s // n for s in sums], [s % n for s in sums]
    u = F.zip_with("x", F.lit(whole).cast("array<long>"), lambda x, m: x - m)
    centred = F.zip_with(u, F.lit([r / n for r in rest]), lambda v, r: v.cast("double") - r)

    block_rows = max(BLOCK_BYTES // (8 * d), 1)
    vectors = fit.select("index", array_to_vector(centred).alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), facts["last"] + 1, d)
    blocks = matrix.toBlockMatrix(block_rows, d)
    splits = -(-(facts["last"] + 1) // (block_rows * SPLIT_BLOCKS))
    scatter = product(blocks.transpose(), blocks, splits).toLocalMatrix().toArray()
    variance, share, axes = components(scatter, n, most)
    k = len(variance)
    if not k:
        return nothing
    whitener = DenseMatrix(d, k, (axes / np.sqrt(variance)).flatten("F"))
    projected = blocks.multiply(BlockMatrix(spark.sparkContext.parallelize([((0, 0), whitener)], 1), d, k))
    found = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    found = found.select("index", vector_to_array("vector").alias("w"))
    widest = facts["high"] - facts["low"] + 1
    known = fit.select("index", *digest(), "copies", deviations(u, n, rest, widest).alias("deviation"))
    white = cut_lineage(known.join(found, "index").drop("index"))

    w = [F.element_at("w", i + 1) for i in range(k)]
    means = list(white.agg(*[F.avg(c) for c in w]).first())
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    moments = white.agg(*[F.sum((w[i] - means[i]) * (w[j] - means[j])) / n for i, j in pairs]).first()
    identity_error = max(abs(m - (i == j)) for (i, j), m in zip(pairs, moments))

    hot = max(HOT_ROWS, facts["rows"] // 1000)
    salts = (F.lit(1) + F.floor(F.col("copies") / hot)).cast("int")
    often = white.filter(F.col("copies") >= hot).select("a", "b", salts.alias("salts"))
    turn = F.pmod(F.monotonically_increasing_id(), F.coalesce("salts", F.lit(1))).cast("int")
    asked = coded.select("vec_id", *digest()).join(F.broadcast(often), ["a", "b"], "left").withColumn("salt", turn)
    held = white.select("a", "b", "deviation", "w", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    shares = F.lit([float(s) for s in share])
    return (asked.join(held, ["a", "b", "salt"])
            .select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", F.element_at(shares, F.col("at") + 1).alias("explained"),
                    F.lit(float(identity_error)).alias("identity_error")))


@register("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
