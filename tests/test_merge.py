from pyspark.sql import functions as F

from skytally.operators import merge


def batch(spark, rows):
    """(key, order, json) → spread fields."""
    df = spark.createDataFrame(rows, "k string, o int, text string").select(
        "k", "o", F.parse_json("text").alias("doc"))
    return merge.spread_fields(df, merge.top_level_fields(df))


def state(df):
    fields = [c for c in df.columns if c not in ("k", "change_type", "batch_rows")]
    return {
        r["k"]: {f: r[f] for f in fields if r[f] is not None} | {"_": r["change_type"]}
        for r in df.select("k", "change_type", *[F.to_json(f).alias(f) for f in fields]).collect()
    }


def stored(df):
    return df.drop("change_type", "batch_rows")


def test_absent_keeps_null_overwrites_nested_replaced(spark):
    first = merge.merge_documents(None, batch(spark, [
        ("a", 1, '{"s":"x","d":{"p":1,"q":2},"n":5}'), (None, 1, '{"s":"y"}')]), ["k"], ["o"])
    assert {v["_"] for v in state(first).values()} == {"inserted"}
    second = merge.merge_documents(stored(first), batch(spark, [
        ("a", 1, '{"d":{"p":9},"n":null}'), (None, 1, '{"s":"z"}'), ("b", 1, '{"new":[1]}')]), ["k"], ["o"])
    assert state(second) == {
        "a": {"s": '"x"', "d": '{"p":9}', "n": "null", "_": "updated"},
        None: {"s": '"z"', "_": "updated"},
        "b": {"new": "[1]", "_": "inserted"},
    }


def test_last_in_batch_wins_per_field(spark):
    rows = [("a", 2, '{"x":2}'), ("a", 1, '{"x":1,"y":1}'), ("a", 3, '{"z":3}')]
    merged = merge.merge_documents(None, batch(spark, rows), ["k"], ["o"])
    assert state(merged)["a"] == {"x": "2", "y": "1", "z": "3", "_": "inserted"}
    assert merge.change_counters(merged).first().asDict() == {
        "valid": 3, "inserted": 1, "updated": 0, "unchanged": 0, "folded": 2}


def test_merge_again_changes_nothing(spark):
    rows = [("a", 1, '{"x":{"b":1,"a":2}}'), ("b", 1, '{"y":null}')]
    first = merge.merge_documents(None, batch(spark, rows), ["k"], ["o"])
    again = merge.merge_documents(stored(first), batch(spark, rows[:1]), ["k"], ["o"])
    assert {k: v["_"] for k, v in state(again).items()} == {"a": "unchanged", "b": "kept"}
    a, b = state(first), state(again)
    assert all({**a[k], "_": 0} == {**b[k], "_": 0} for k in a)


def test_ignored_field_is_no_change(spark):
    first = merge.merge_documents(None, batch(spark, [("a", 1, '{"x":1,"_meta":{"t":1}}')]), ["k"], ["o"])
    again = merge.merge_documents(stored(first), batch(spark, [("a", 1, '{"x":1,"_meta":{"t":2}}')]), ["k"], ["o"])
    assert state(again)["a"] == {"x": "1", "_meta": '{"t":2}', "_": "unchanged"}


def test_hot_key_is_combined_before_the_shuffle(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("int").alias("o"), F.parse_json(F.format_string('{"v":%d}', "id")).alias("doc"))
    merged = merge.merge_documents(None, merge.spread_fields(rows, ["v"]), ["k"], ["o"])
    assert merged.count() == 1 + 20_000 - 6_667
    hot = merged.where("k = 'hot'").select(F.to_json("v"), "batch_rows").first()
    assert tuple(hot) == ("19998", 6_667)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan and "Window" not in plan


def test_relational_null_keys_never_conflict(spark):
    schema = "a string, b string, v int, created_at int"
    table = spark.createDataFrame([("x", "y", 1, 10), ("x", None, 1, 10)], schema)
    new = spark.createDataFrame([("x", "y", 2, 20), ("x", None, 2, 20), ("n", "m", 3, 30), ("n", "m", 4, 31)], schema)
    merged = merge.merge_relational(table, new, ["a", "b"], ["v"])
    assert sorted(map(tuple, merged.collect()), key=str) == sorted([
        ("x", "y", 2, 10), ("x", None, 1, 10), ("x", None, 2, 20), ("n", "m", 4, 30)], key=str)


def test_relational_empty_batch_is_a_no_op(spark):
    table = spark.createDataFrame([("x", 1)], "a string, v int")
    assert merge.merge_relational(table, table.limit(0), ["a"]).collect() == table.collect()
