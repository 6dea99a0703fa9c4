"""Skewed joins against a plain computation."""

import pytest
from pyspark.sql import functions as F

from relayframe.operators.lookups import bounded_hot_keys, hot_keys, join_lookup, latest_by


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds a third of the rows; some keys have no partner."""
    return spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_rows", [0, 100])
def test_join_lookup_is_the_plain_join(spark, skewed, how, max_rows):
    lookup = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = join_lookup(skewed, lookup, ["k"], how, spread_by=F.col("id"), rows_per_task=100,
                      max_rows=max_rows)
    want = skewed.join(lookup, "k", how)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_hot_key_gets_as_many_tasks_as_it_needs(skewed):
    hot = {r.k: r.n_salts for r in hot_keys(skewed, ["k"], 100).collect()}
    assert hot == {0: -(-skewed.filter("k = 0").count() // 100)}


def test_too_many_hot_keys_raise_the_share(skewed):
    hot = bounded_hot_keys(lambda share: hot_keys(skewed, ["k"], share), 10, max_rows=3)
    assert [r.k for r in hot.collect()] == [0]
    assert bounded_hot_keys(lambda share: hot_keys(skewed, ["k"], share), 10_000) is None


def test_latest_by_takes_the_last_row(spark):
    rows = [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), ("b", 5, 1, "w")]
    df = spark.createDataFrame(rows, "k string, t int, n int, v string")
    got = {tuple(r) for r in latest_by(df, ["k"], ["t", "n"], ["v"]).collect()}
    assert got == {("a", "z"), ("b", "w")}


def test_null_keys_keep_their_rows(spark):
    big = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    lookup = spark.createDataFrame([("a", 1)], "k string, v int")
    for max_rows in (0, 10):
        got = join_lookup(big, lookup, ["k"], "left", spread_by=F.col("id"), max_rows=max_rows)
        assert {(r.id, r.v) for r in got.collect()} == {(1, 1), (2, None)}
