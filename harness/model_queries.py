"""What the model sees and how its trees score, checked in SQL."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from harness import inputs, stored
from harness.bi_queries import HAVERSINE
from harness.registry import query
from harness.state_queries import training_rows
from skytally.plans import features, model, trees
from skytally.schemas import FEATURES
from skytally.session import cut_lineage, scratch_path

DOMESTIC = "origin LIKE 'LF%' AND destination LIKE 'LF%'"

# --- feature matrix ------------------------------------------------------------------------------


def history_matrix(spark, sf_dir):
    def build():
        rows = features.complete_features(features.history_features(inputs.history_text(spark, sf_dir)))
        kept = cut_lineage(rows.select("`ECTRL ID`", *[F.col(f"`{c}`") for c in FEATURES]))
        return kept, Pipeline(stages=model.feature_stages()).fit(kept)

    return stored.once("matrix", spark, sf_dir, build)


RAW_FEATURES = {
    "Latitude": "adep_lat", "Longitude": "adep_lon", "Requested FL": "CAST(requested_fl AS DOUBLE)",
    "Actual Distance Flown (nm)": HAVERSINE.format(a="adep_lat", b="ades_lat", c="adep_lon", d="ades_lon"),
    "month": "month(filed_dep)", "hour": "hour(filed_dep)", "day_of_week": "dayofweek(filed_dep) + 1",
}


@query("scaled_features", views=("v_hist",), oracle="SELECT CAST(flight_id AS VARCHAR) AS \"ECTRL ID\", " + ", ".join(
    f'round(({sql} - AVG({sql}) OVER ()) / STDDEV_SAMP({sql}) OVER (), 6) AS "{name}"' for name, sql in RAW_FEATURES.items())
    + f" FROM v_hist WHERE {DOMESTIC}")
def scaled_features(spark, sf_dir):
    rows, fitted = history_matrix(spark, sf_dir)
    return model.feature_matrix(fitted, rows, ["ECTRL ID"]).select("`ECTRL ID`", *[F.col(f"`{c}`") for c in RAW_FEATURES])


@query("operator_one_hot", views=("v_hist",), oracle=f"""
SELECT operator, operator AS slot, row_number() OVER (ORDER BY COUNT(*) DESC, operator) - 1 AS position,
       COUNT(*) AS flights, CAST(COUNT(*) AS DOUBLE) AS ones
FROM v_hist WHERE {DOMESTIC} GROUP BY operator""")
def operator_one_hot(spark, sf_dir):
    rows, fitted = history_matrix(spark, sf_dir)
    slots = [n for n in model.feature_names(fitted) if n not in RAW_FEATURES]
    matrix = model.feature_matrix(fitted, rows, ["AC Operator"])
    cells = F.explode(F.array(*[
        F.struct(F.lit(n.split("=", 1)[1]).alias("slot"), F.lit(i).alias("position"), F.col(f"`{n}`").alias("v"))
        for i, n in enumerate(slots)])).alias("cell")
    lit = matrix.select(F.col("`AC Operator`").alias("operator"), cells).select("operator", "cell.*").where("v <> 0")
    return lit.groupBy("operator", "slot", "position").agg(F.count(F.lit(1)).alias("flights"), F.sum("v").alias("ones"))


# --- trees as a relation ---------------------------------------------------------------------------

# A small ensemble over (requested_fl, origin latitude, hour); leaves have a value only.
SMALL_TREES = """
  (0, 0, 0, 200.0, 1, 2, NULL), (0, 1, 1, 45.0, 3, 4, NULL), (0, 2, NULL, NULL, NULL, NULL, 0.7),
  (0, 3, NULL, NULL, NULL, NULL, -0.4), (0, 4, 2, 12.0, 5, 6, NULL), (0, 5, NULL, NULL, NULL, NULL, 0.1),
  (0, 6, NULL, NULL, NULL, NULL, 0.25), (1, 0, 2, 6.0, 1, 2, NULL), (1, 1, NULL, NULL, NULL, NULL, -0.3),
  (1, 2, 0, 320.0, 3, 4, NULL), (1, 3, NULL, NULL, NULL, NULL, 0.2), (1, 4, NULL, NULL, NULL, NULL, -0.55),
  (2, 0, NULL, NULL, NULL, NULL, 0.05)"""


@query("tree_relation", views=("v_hist",), oracle=f"""
WITH RECURSIVE nodes AS (SELECT * FROM (VALUES {SMALL_TREES}) AS n (tree, node, feature, threshold, l, r, value)),
input AS (SELECT row_number() OVER () AS id, flight_id, [CAST(requested_fl AS DOUBLE), adep_lat, CAST(hour(filed_dep) AS DOUBLE)] AS f FROM v_hist),
walk AS (
  SELECT id, flight_id, f, tree, 0 AS node FROM input, (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT id, flight_id, f, w.tree, CASE WHEN f[n.feature + 1] <= n.threshold THEN n.l ELSE n.r END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.feature IS NOT NULL)
SELECT flight_id, CASE WHEN SUM(value) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(1 / (1 + exp(-2 * SUM(value))), 6) AS chance
FROM walk JOIN nodes USING (tree, node) WHERE value IS NOT NULL GROUP BY id, flight_id""")
def tree_relation(spark, sf_dir):
    nodes = spark.sql(f"""SELECT tree, node, feature, CAST(threshold AS DOUBLE) AS threshold,
        CAST(NULL AS ARRAY<DOUBLE>) AS categories, l AS left, r AS right,
        CAST(value AS DOUBLE) AS value, CAST(NULL AS ARRAY<DOUBLE>) AS stats, 1D AS weight
        FROM VALUES {SMALL_TREES} AS n (tree, node, feature, threshold, l, r, value)""")
    flights = inputs.table(spark, sf_dir, "v_hist").select(
        F.struct(F.monotonically_increasing_id().alias("id"), "flight_id").alias("key"),
        F.array(F.col("requested_fl").cast("double"), "adep_lat", F.hour("filed_dep").cast("double")).alias("features"))
    scores = trees.boosting_scores(trees.leaves(cut_lineage(flights), nodes, 3))
    return scores.select("key.flight_id", "prediction", "chance")


@query("forest_votes", views=("v_hist",), oracle=f"""
SELECT kind, COUNT(*) AS rows, COUNT(*) AS same_prediction, COUNT(*) AS same_chance
FROM v_hist, (VALUES ('boosting'), ('forest')) AS k (kind) WHERE {DOMESTIC} GROUP BY kind""")
def forest_votes(spark, sf_dir):
    """All rows scored by the fitted model and by its node relation, and how many agree."""
    rows = cut_lineage(model.prepare_training(training_rows(spark, sf_dir), max_rows=0).withColumn(
        "key", F.monotonically_increasing_id()))
    compared = []
    for kind, preset, size in (("forest", "forest_job", {"numTrees": 12, "maxDepth": 8}),
                               ("boosting", "boosting_notebook", {"maxIter": 8})):
        path = scratch_path(spark, "model")
        model.train(rows, preset, **size).write().save(path)
        fitted = PipelineModel.load(path)
        by_nodes = trees.relation_scores(fitted, trees.node_rows(spark, path), rows)
        by_model = fitted.transform(rows).select("key", F.col("prediction").alias("p"), vector_to_array("probability")[1].alias("c"))
        close = F.abs(F.col("c") - F.col("chance")) < 1e-9
        # Equal votes may be summed up in another order; the prediction then is free.
        same = (F.col("p") == F.col("prediction")) | (close & (F.abs(F.col("c") - 0.5) < 1e-9))
        compared.append(by_model.join(by_nodes, "key").agg(
            F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("rows"), F.count_if(same).alias("same_prediction"),
            F.count_if(close).alias("same_chance")))
    return compared[0].unionByName(compared[1])
