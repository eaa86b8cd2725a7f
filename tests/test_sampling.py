import pytest
from pyspark.sql import functions as F

from skytally.operators import sampling


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(5_000).select(
        (F.col("id") % 5 == 0).cast("int").alias("y"), F.col("id"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 11).alias("x y"))


def test_exact_and_independent_of_partitioning(rows):
    quota = {0: 1234, 1: 77}
    first = sampling.pick_per_class(rows, "y", quota, 84).where("picked")
    assert dict(first.groupBy("y").count().collect()) == quota
    again = sampling.pick_per_class(rows.repartition(7, "x y"), "y", quota, 84).where("picked")
    assert first.exceptAll(again).isEmpty()
    other = sampling.pick_per_class(rows, "y", quota, 85).where("picked")
    assert not first.exceptAll(other).isEmpty()


def test_nothing_is_lost_or_repeated(rows):
    marked = sampling.pick_per_class(rows, "y", {0: 10, 1: 1000}, 1)
    assert rows.exceptAll(marked.drop("picked")).isEmpty() and marked.count() == 5_000
    assert dict(marked.where("picked").groupBy("y").count().collect()) == {0: 10, 1: 1000}
    lone = sampling.pick_per_class(rows, "y", {1: 5}, 1)
    assert dict(lone.where("picked").groupBy("y").count().collect()) == {1: 5} and lone.count() == 5_000


def test_copies_are_counted_exactly(spark):
    same = spark.range(3_000).select(F.lit(1).alias("y"), F.lit("copy").alias("t"))
    mixed = same.unionByName(spark.range(2_000).select(F.lit(1).alias("y"), F.col("id").cast("string").alias("t")))
    for wanted in (0, 1, 2_999, 3_000, 4_321, 5_000):
        marked = sampling.pick_per_class(mixed, "y", {1: wanted}, 3)
        assert marked.where("picked").count() == wanted
        assert marked.count() == 5_000


def test_sample_quota_rule():
    assert sampling.sample_quota({0: 900, 1: 100, 2: 1}, 100) == {0: 89, 1: 9, 2: 1}


def test_small_input_is_returned_whole(rows):
    assert sampling.stratified_sample(rows, "y", 10_000, 1) is rows
    assert sampling.stratified_sample(rows, "y", 0, 1) is rows


def test_split(rows, spark):
    train, test = sampling.split_train_test(rows, "y", 0.2, 84)
    assert dict(test.groupBy("y").count().collect()) == {0: 800, 1: 200}
    assert train.count() == 4_000 and train.intersect(test).isEmpty()
    lone = spark.createDataFrame([(0, i) for i in range(9)] + [(1, 99)], "y int, v int")
    train, test = sampling.split_train_test(lone, "y", 0.2, 84)
    assert (train.count(), test.count()) == (8, 2)


def test_holdout_quota_sums_up():
    assert sampling.holdout_quota({0: 7, 1: 5}) == {0: 2, 1: 1}
    assert sum(sampling.holdout_quota({0: 101, 1: 52, 2: 3}).values()) == 32


def test_bernoulli_is_seeded(rows):
    assert sampling.bernoulli_sample(rows).collect() == sampling.bernoulli_sample(rows).collect()
