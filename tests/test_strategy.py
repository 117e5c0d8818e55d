"""Joins whose smaller side fails the broadcast check: merged, hot keys salted, every row kept."""

import pytest
from pyspark.sql import functions as F

from apiary.operators import strategy
from apiary.plans import catalog
from support import SF_SMALL, plan_text


@pytest.mark.parametrize("name", ["sensor_day_join_keyed", "hive_average", "hive_report", "hive_count_sum", "subday_average"])
def test_a_side_that_fails_the_check_is_merged(spark, monkeypatch, name):
    want = sorted(catalog.QUERIES[name](spark, SF_SMALL).collect())
    monkeypatch.setattr(strategy, "bounded", lambda df, max_rows: False)
    df = catalog.QUERIES[name](spark, SF_SMALL)
    assert sorted(df.collect()) == want
    # Spark's estimate of these tables is far below its threshold; only the list of hot keys may be broadcast.
    plan = plan_text(df).split("== Initial Plan ==")[0]
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("BroadcastHashJoin") == 2


def test_unsalted_join_is_merged(spark):
    a, b = spark.range(50).withColumn("x", F.col("id") % 7), spark.range(20)
    df = strategy.join_small(a, b, "id", max_rows=1)
    assert len(df.collect()) == 20
    assert "SortMergeJoin" in plan_text(df) and "BroadcastHashJoin" not in plan_text(df)


def test_hot_keys_are_the_commonest(spark):
    df = spark.createDataFrame([(k,) for k in [1] * 5 + [2] * 9 + [3] + [None] * 20], "k int")
    assert {r.k for r in strategy.hot_keys(df, ["k"], most=2).collect()} == {1, 2}


def test_only_hot_keys_are_replicated(spark):
    hot = spark.createDataFrame([(1, True), (2, True)], "k bigint, _hot boolean")
    out = strategy.replicated(spark.range(100).withColumnRenamed("id", "k"), hot, ["k"], 16)
    assert out.count() == 98 + 2 * 16
    assert out.where("k in (1, 2)").select("k", "_salt").distinct().count() == 2 * 16


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_keeps_null_keys_unmatched_rows_and_repeats(spark, monkeypatch, how):
    monkeypatch.setattr(strategy, "hot_keys", lambda df, keys, f=strategy.hot_keys: f(df, keys, 2))
    large = spark.range(400).select(
        F.when(F.col("id") % 4 == 0, F.lit(7)).when(F.col("id") % 4 == 1, F.col("id") % 30).alias("k"), "id"
    )
    small = spark.createDataFrame([(7, "a"), (7, "b"), (1, "c"), (13, "d"), (99, "e"), (None, "f")], "k bigint, v string")
    got = strategy.join_small(large, small, "k", how, max_rows=1, salt_buckets=4)
    want = large.join(small, "k", how)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_keys_of_two_types_are_not_salted(spark):
    large = spark.createDataFrame([("1",), ("01",), ("2",)], "k string")
    small = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    got = strategy.join_small(large, small, "k", max_rows=1, salt_buckets=4)
    assert sorted(r.v for r in got.collect()) == sorted(r.v for r in large.join(small, "k").collect())
