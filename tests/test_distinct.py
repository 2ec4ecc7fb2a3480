"""Exact distinct counts in one shuffle: results, plan, shuffled rows, and hot groups."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from earshot.operators import distinct, marts
from earshot.plans import suite

def totals():
    return {"n": F.count(F.lit(1)), "total": F.sum("v")}


def rows(spark, n=5000, hot=0):
    """``hot``: how many of the rows belong to one key."""
    df = spark.range(n).select(
        F.when(F.col("id") < hot, 7).otherwise(F.col("id") * 7919 % 40).cast("long").alias("k"), (F.col("id") % 3).alias("k2"),
        (F.col("id") * 31 % 101).alias("a"), (F.col("id") * 17 % 53).cast("string").alias("b"), (F.col("id") % 11 - 5).alias("v"))
    return df.withColumns({c: F.when(F.col("v") != x, F.col(c)) for c, x in (("a", 2), ("b", 3), ("k", 4))}).withColumn(
        "v", F.when(F.col("a") != 50, F.col("v"))).repartition(5)


def same(df, other):
    assert sorted(map(tuple, df.select(*sorted(df.columns)).collect())) == sorted(map(tuple, other.select(*sorted(df.columns)).collect()))


def plain(df):
    return df.where("k is not null and k2 is not null").groupBy("k", "k2").agg(
        F.count_distinct("a").alias("as"), F.count_distinct("b").alias("bs"), *(c.alias(n) for n, c in totals().items()))


@pytest.mark.parametrize("hot", [0, 3000])
def test_equals_count_distinct(spark, hot):
    df = rows(spark, hot=hot)
    same(distinct.distinct_totals(df, ["k", "k2"], {"as": "a", "bs": "b"}, totals()), plain(df))
    same(distinct.distinct_totals(df.where("false"), ["k", "k2"], {"as": "a", "bs": "b"}, totals()), plain(df.where("false")))


def test_hot_groups_go_another_way_with_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(distinct, "ONE_TASK", 0)
    monkeypatch.setattr(distinct, "HOT_ROWS", 500)
    df = rows(spark, hot=3000)
    hot = distinct.hot_keys(df.where("k is not null"), ["k", "k2"])
    want = {r[0] for r in df.where("k = 7").select(F.xxhash64("k", "k2")).distinct().collect()}
    assert set(hot) == want and len(want) == 3
    found = distinct.distinct_totals(df, ["k", "k2"], {"as": "a", "bs": "b"}, totals())
    same(found, plain(df))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and " Expand " not in plan
    sides = [x for x in plan.splitlines() if "hashpartitioning" in x]
    assert any("v0" in x for x in sides)            # the hot groups' rows are spread by value


def shuffled(spark, df):
    """Rows written by the exchanges of a run, by the plan's own metrics."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0

    def walk(node):
        nonlocal total
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            total += int(node.metrics().apply("shuffleRecordsWritten").value())
        children = [node.children().apply(i) for i in range(node.children().size())]
        if name == "AdaptiveSparkPlanExec":
            children = [node.executedPlan()]
        elif name.endswith("QueryStageExec"):
            children = [node.plan()]
        for c in children:
            walk(c)
    walk(plan)
    return total


def test_daily_mart_shuffles_each_event_once(spark):
    fact = suite._fact(spark, SF_MID).repartition(8).cache()
    try:
        n = fact.count()
        new = marts.daily_totals(fact)
        assert "Expand" not in new._jdf.queryExecution().executedPlan().toString()
        old = fact.groupBy("date_key", "user_key").agg(
            F.count_distinct("track_key").alias("unique_tracks"), F.count_distinct("session_id").alias("sessions"))
        assert shuffled(spark, new) == n and shuffled(spark, old) > 2 * n
        same(new.select("date_key", "user_key", "unique_tracks", "sessions"), old)
    finally:
        fact.unpersist()
