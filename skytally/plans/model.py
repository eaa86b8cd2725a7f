"""Delay classifier with Spark ML: preparation, training, scoring, evaluation, persistence."""

from __future__ import annotations

import json
import math

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skytally.functions.scalars import to_number
from skytally.operators.sampling import class_counts, split_train_test, stratified_sample
from skytally.operators.search import require_columns
from skytally.schemas import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES, TARGET
from skytally.session import cut_lineage

SEED = 84
MAX_TRAINING_ROWS = 300_000
ROWS_PER_TASK = 50_000
WEIGHT = "_weight"

# Training presets.
PRESETS = {
    "forest_job": dict(kind="forest", balanced=True, params=dict(
        numTrees=50, maxDepth=12, minInstancesPerNode=20, maxMemoryInMB=1024)),
    "forest_notebook": dict(kind="forest", balanced=False, params=dict(
        numTrees=100, maxDepth=15, maxMemoryInMB=1024)),
    "boosting_notebook": dict(kind="boosting", balanced=False, params=dict(
        maxIter=100, maxDepth=6, stepSize=0.1)),
}


def class_distribution(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Count and share per class; the window runs over the few class rows."""
    total = F.sum("count").over(W.partitionBy())
    return (
        df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
        .withColumn("share", F.col("count") / total)
        .orderBy(label)
    )


def check_classes(df: DataFrame, label: str = TARGET) -> dict[object, int]:
    counts = class_counts(df, label)
    if not counts:
        raise ValueError("the training dataset is empty after dropping incomplete rows")
    if len(counts) < 2:
        raise ValueError("the target has one class; training needs delayed and on-time examples")
    return counts


def coerce_training(table: DataFrame) -> DataFrame:
    """Numeric columns from text, complete rows only, integer target."""
    require_columns(table, [TARGET, *FEATURES])
    texts = {name for name, kind in table.dtypes if kind == "string"} - set(CATEGORICAL_FEATURES)
    columns = [
        (to_number(F.col(f"`{c}`")) if c in texts else F.col(f"`{c}`")).alias(c)
        for c in [TARGET, *FEATURES]
    ]
    return table.select(columns).dropna().withColumn(TARGET, F.col(TARGET).cast("bigint"))


def prepare_training(table: DataFrame, max_rows: int = MAX_TRAINING_ROWS, seed: int = SEED) -> DataFrame:
    """Training rows; above ``max_rows`` an exact stratified sample (0 keeps all).

    The rows are written once: the class counts, the picks and the fit all start from them.
    """
    rows = cut_lineage(coerce_training(table))
    check_classes(rows)
    return stratified_sample(rows, TARGET, max_rows, seed)


def balance_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Weight n / (classes · n_class) as a literal per class."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    weight = F.lit(1.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, total / (len(counts) * n)).otherwise(weight)
    return df.withColumn(WEIGHT, weight)


def build_pipeline(preset: str = "forest_job", seed: int = SEED, **overrides) -> Pipeline:
    """Scaling, one-hot and classifier.

    ``handleInvalid="keep"`` gives unseen operators an extra index that ``dropLast`` removes, so
    they encode to zeros (:func:`feature_stages`).
    """
    if preset not in PRESETS:
        raise ValueError(f"unknown preset {preset!r}, expected one of {sorted(PRESETS)}")
    chosen = PRESETS[preset]
    params = {**chosen["params"], **overrides}
    common = dict(featuresCol="features", labelCol=TARGET, seed=seed, **params)
    if chosen["kind"] == "forest":
        classifier = RandomForestClassifier(**common)
    else:
        classifier = GBTClassifier(**common)
    if chosen["balanced"]:
        classifier.setWeightCol(WEIGHT)
    return Pipeline(stages=[*feature_stages(), classifier])


def feature_stages() -> list:
    """Scaled numbers and the one-hot operator, in this order, as ``features``."""
    category = CATEGORICAL_FEATURES[0]
    return [
        VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="_numeric"),
        StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True, withStd=True),
        StringIndexer(inputCol=category, outputCol="_category", handleInvalid="keep"),
        OneHotEncoder(inputCols=["_category"], outputCols=["_onehot"], dropLast=True),
        VectorAssembler(inputCols=["_scaled", "_onehot"], outputCol="features"),
    ]


def feature_names(fitted: PipelineModel) -> list[str]:
    """Names of the slots of ``features``: numbers by their column, operators by their value."""
    indexer = next(s for s in fitted.stages if hasattr(s, "labelsArray"))
    return [*NUMERIC_FEATURES, *[f"{CATEGORICAL_FEATURES[0]}={v}" for v in indexer.labelsArray[0]]]


def feature_matrix(fitted: PipelineModel, rows: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and what the classifier sees, a column per slot."""
    stages = [s for s in fitted.stages if not hasattr(s, "featureImportances")]
    made = PipelineModel(stages).transform(rows).select(*[F.col(f"`{c}`") for c in keep], vector_to_array("features").alias("_f"))
    return made.select(*[F.col(f"`{c}`") for c in keep], *[
        F.col("_f")[n].alias(name) for n, name in enumerate(feature_names(fitted))])


def train(rows: DataFrame, preset: str = "forest_job", seed: int = SEED, **overrides) -> PipelineModel:
    """Fit on all rows, distributed. The rows are kept for the several passes of the fit.

    A fit runs some jobs per level of each boosting round, so the shuffle partitions of the split, most of
    them nearly empty, are put together to a task per slot, and one per ``ROWS_PER_TASK`` rows.
    """
    if PRESETS.get(preset, {}).get("balanced"):
        rows = balance_weights(rows)
    kept = rows.persist()
    try:
        slots = rows.sparkSession.sparkContext.defaultParallelism
        return build_pipeline(preset, seed, **overrides).fit(
            kept.coalesce(max(slots, math.ceil(kept.count() / ROWS_PER_TASK))))
    finally:
        kept.unpersist()


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Add predicted_is_delayed and delay_probability (null when the model has none)."""
    scored = model.transform(features)
    chance = F.lit(None).cast("double")
    if "probability" in scored.columns:
        chance = vector_to_array("probability")[1]
    return scored.select(
        *[F.col(f"`{c}`") for c in features.columns],
        (F.col("prediction") == 1).alias("predicted_is_delayed"),
        chance.alias("delay_probability"),
    )


def confusion_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Confusion counts, precision, recall, F1 and support per class, accuracy and averages.

    One pass of four conditional counts; a zero denominator gives 0.
    """
    y, p = F.col(label).cast("int"), F.col(predicted).cast("int")
    cells = df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"),
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def measures(hit, wrong, missed):
        precision, recall = ratio(hit, hit + wrong), ratio(hit, hit + missed)
        f1 = ratio(2.0 * hit, 2 * hit + wrong + missed)
        return precision, recall, f1, hit + missed

    on_time, delayed = measures(tn, fn, fp), measures(tp, fp, fn)
    total = tn + fp + fn + tp
    accuracy = ratio(tn + tp, total)
    macro = [(a + b) / 2 for a, b in zip(on_time[:3], delayed[:3])]
    weighted = [ratio(a * on_time[3] + b * delayed[3], total) for a, b in zip(on_time[:3], delayed[:3])]

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("label"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.alias("support"),
        )

    lines = F.array(
        row("on_time", *on_time), row("delayed", *delayed),
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro", *macro, total), row("weighted", *weighted, total),
    )
    return cells.select("tn", "fp", "fn", "tp", F.explode(lines).alias("r")).select(
        "r.*", "tn", "fp", "fn", "tp"
    )


def train_and_evaluate(
    dataset: DataFrame, preset: str = "forest_job", seed: int = SEED, max_rows: int = 0, **overrides
) -> tuple[PipelineModel, DataFrame]:
    """Exact stratified 80/20 split of all rows, fit on the whole training side (at most ``max_rows`` of it if
    given), report on every held-out row."""
    training, held_out = split_train_test(dataset, TARGET, 0.2, seed)
    model = train(stratified_sample(training, TARGET, max_rows, seed), preset, seed, **overrides)
    return model, confusion_report(score(model, held_out), TARGET, "predicted_is_delayed")


def save_model(model: PipelineModel, path: str, spark: SparkSession, source_table: str, preset: str) -> None:
    """Model artifact and a one-row JSON sidecar next to it."""
    model.write().overwrite().save(path)
    details = json.dumps({
        "feature_columns": FEATURES, "numeric_columns": NUMERIC_FEATURES,
        "categorical_columns": CATEGORICAL_FEATURES, "target_column": TARGET,
        "model_type": PRESETS[preset]["kind"], "model_random_state": SEED,
        "data_source": source_table,
    })
    spark.createDataFrame([(details,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}.metadata"
    )


def load_model(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except (AnalysisException, OSError) as error:
        raise FileNotFoundError(f"no delay model at {path}") from error
    except Exception as error:  # the JVM reports a missing path as an input error
        if "does not exist" in str(error).lower():
            raise FileNotFoundError(f"no delay model at {path}") from error
        raise
