"""Feature matrix and trees as a relation, against the fitted model and plain Python."""

import random
import statistics

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from skytally.plans import model, trees
from skytally.schemas import FEATURES, NUMERIC_FEATURES, TARGET
from skytally.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    data = []
    for n in range(600):
        hour, operator = rng.randrange(24), rng.choice("ABCDE")
        late = (hour > 14) ^ (operator in "BD") ^ (rng.random() < 0.1)
        data.append((n, int(late), rng.uniform(41, 51), rng.uniform(-5, 8), float(rng.randrange(100, 400, 10)),
                     rng.uniform(50, 700), f"OP{operator}", rng.randrange(1, 13), hour, rng.randrange(1, 8)))
    names = ["key", TARGET, *FEATURES]
    return spark.createDataFrame(data, names).select("key", F.col(TARGET).cast("bigint").alias(TARGET), *[f"`{c}`" for c in FEATURES])


@pytest.mark.parametrize("preset, size", [
    ("forest_job", {"numTrees": 7, "maxDepth": 6, "minInstancesPerNode": 5}), ("boosting_notebook", {"maxIter": 6, "maxDepth": 4})])
def test_relation_scores_as_the_model(spark, rows, preset, size):
    path = scratch_path(spark, "model")
    model.train(rows, preset, **size).write().save(path)
    fitted = PipelineModel.load(path)
    nodes = trees.node_rows(spark, path)
    assert nodes.where("categories is not null").count() and nodes.where("threshold is not null").count()
    other = rows.withColumn("AC Operator", F.when(F.col("key") % 7 == 0, "unseen").otherwise(F.col("`AC Operator`")))
    mine = {r.key: r for r in trees.relation_scores(fitted, nodes, other).collect()}
    theirs = fitted.transform(other).select("key", "prediction", vector_to_array("probability")[1].alias("c")).collect()
    assert len(mine) == len(theirs) == 600
    for r in theirs:
        assert mine[r.key].chance == pytest.approx(r.c, abs=1e-9)
        assert mine[r.key].prediction == r.prediction or abs(r.c - 0.5) < 1e-9


def test_leaves_of_a_tree_that_is_one_leaf(spark):
    nodes = spark.createDataFrame([(0, 0, None, None, None, None, None, 2.0, None, 0.5)], trees.NODES)
    rows = spark.createDataFrame([(1, [3.0]), (2, [])], "key int, features array<double>")
    scores = trees.boosting_scores(trees.leaves(rows, nodes, 3)).collect()
    assert sorted((r.key, r.prediction) for r in scores) == [(1, 1.0), (2, 1.0)]


def test_feature_matrix(spark, rows):
    fitted = model.train(rows, "forest_job", numTrees=2, maxDepth=2)
    unseen = rows.where("key = 1").withColumns({"key": F.lit(-1), "AC Operator": F.lit("unseen")})
    matrix = {r["key"]: r for r in model.feature_matrix(fitted, rows.unionByName(unseen), ["key"]).collect()}
    raw = {r["key"]: r for r in rows.collect()}
    for name in NUMERIC_FEATURES:
        values = [r[name] for r in raw.values()]
        mean, deviation = statistics.fmean(values), statistics.stdev(values)
        for key, r in raw.items():
            assert matrix[key][name] == pytest.approx((r[name] - mean) / deviation)
    slots = [n for n in model.feature_names(fitted) if n.startswith("AC Operator=")]
    for key, r in raw.items():
        assert [n for n in slots if matrix[key][n]] == [f"AC Operator={r['AC Operator']}"]
    assert not any(matrix[-1][n] for n in slots)
