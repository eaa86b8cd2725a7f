"""Registered queries against DuckDB, plans of the native ones, and the pipeline."""

import pytest

import corpus_pipeline
from harness.compare import connect
from skytally.llm import jaccard, quality
from skytally.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = connect(SF_DIR).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, cursor.fetchall())) == sorted(repr(tuple(r)) for r in df.select(columns).collect())


@pytest.mark.parametrize("name", ["op1_quality_divergence", "op5_pii_weak_labels", "op9_url_templates"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin") if b in plan]


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = corpus_pipeline.drop_low_quality(spark, docs, SF_DIR)
    wanted = {r["doc_id"] for r in quality.quality_report(docs).filter("kept").collect()}
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == wanted
    single = corpus_pipeline.drop_near_duplicates(spark, good, SF_DIR)
    classes = jaccard.link_classes(good).collect()
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({r["component_id"] for r in classes})
    for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.mask_secrets):
        assert stage(spark, odd_docs, SF_DIR).columns == odd_docs.columns
        assert stage(spark, no_docs, SF_DIR).count() == 0
    assert corpus_pipeline.drop_near_duplicates(spark, odd_docs, SF_DIR).filter("doc_id = 9").count() == 0


def test_near_duplicates_keep_a_row_of_each_class(spark):
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    near = words(2) + " more"
    rows = [(None, words(1)), (None, words(1)), (7, words(2)), (7, words(3)), (3, near), (7, near), (9, words(4)),
            (None, words(4)), (None, words(5)), (None, words(5) + " more"), (7, None), (7, None), (7, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, df, SF_DIR)
    found = sorted(map(tuple, got.collect()), key=repr)
    fifth = [r for r in found if r[0] is None and r[1].startswith(words(5))]
    assert len(fifth) == 1
    assert sorted([*found, (0, "")], key=repr) == sorted(
        [(None, words(1)), *fifth, (7, words(3)), (3, near), (9, words(4)), (7, None), (7, None), (7, " "), (0, "")], key=repr)


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.count() > 0 and {"doc_id", "bin_id", "bin_length"} <= set(rows.columns)
