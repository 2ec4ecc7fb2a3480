"""One user and one track holding a third of all events: results stay exact and every
per-key reduction combines map side (no task receives a hot key's rows)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from harness import compare
from earshot.operators import dims, facts, marts
from earshot.plans import oracle, suite

SKEW_SQL = """
ev_skew AS (
  SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 'user_00000' ELSE user_id END AS user_id,
                    CASE WHEN event_id % 3 = 1 THEN 't000' ELSE track_id END AS track_id) FROM ev
)"""


def skewed(ev):
    return ev.withColumns({
        "user_id": F.when(F.col("event_id") % 3 == 0, F.lit("user_00000")).otherwise(F.col("user_id")),
        "track_id": F.when(F.col("event_id") % 3 == 1, F.lit("t000")).otherwise(F.col("track_id")),
    })


def body_of(sql):
    """The final SELECT of an oracle statement (its CTEs are replaced by the skewed ones)."""
    return "SELECT" + sql.split("\nSELECT", 1)[1]


def ctes():
    return oracle._cte(oracle.OVERLAY, SKEW_SQL, oracle.dims_sql("ev_skew"))


def test_skewed_dims_and_marts_exact(spark, duck_small):
    ev = skewed(suite._events(spark, SF_SMALL))
    tie = ["event_id"]
    f = facts.fact_listens(ev, arrival="event_id")
    du = suite.conform(dims.dim_users(ev, tie=tie), suite.DIM_USERS, loaded_at=suite.LOADED_AT)
    checks = {
        "dim_users": (dims.dim_users(ev, tie=tie),
                      "SELECT user_key, user_id, first_seen, last_seen, primary_device FROM dim_users"),
        "dim_tracks": (dims.dim_tracks(ev, tie=tie), "SELECT * FROM dim_tracks"),
        "daily": (marts.daily_user_summary(f, du, dims.dim_date(ev)),
                  body_of(oracle.DAILY_USER_SUMMARY)),
        "tracks": (marts.track_performance(f, dims.dim_tracks(ev, tie=tie)),
                   body_of(oracle.TRACK_PERFORMANCE)),
    }
    for name, (df, body) in checks.items():
        r = compare(spark, duck_small, name, df, oracle.with_(ctes(), body))
        assert r["ok"], r


def test_hot_key_reductions_combine_map_side(spark):
    ev = skewed(suite._events(spark, SF_SMALL))
    for df in (dims.dim_users(ev, tie=["event_id"]), dims.dim_tracks(ev, tie=["event_id"])):
        p = df._jdf.queryExecution().executedPlan().toString()
        before_shuffle = p.split("Exchange hashpartitioning", 1)[1]
        assert "partial_" in before_shuffle, p
        assert "Window" not in p


def test_aqe_splits_a_hot_user_in_the_lookup_join(spark, tmp_path):
    """With a stored dimension too large to broadcast, the lookup join is a sort-merge
    join; AQE splits the hot user's partition (thresholds scaled down to test size).
    (AQE splits only joins whose inputs come straight from a shuffle, as with a stored
    dimension; a dimension aggregated in the same query is not split.)"""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        from conftest import SF_MID
        ev = skewed(suite._events(spark, SF_MID))
        dims.dim_users(ev, tie=["event_id"]).write.parquet(str(tmp_path / "dim_users"))
        du = spark.read.parquet(str(tmp_path / "dim_users"))
        df = facts.lookup_key(ev.select("event_id", "user_id"), du, "user_id", "user_key")
        n = len(df.collect())          # runs this DataFrame's own plan to its final form
        p = df._jdf.queryExecution().executedPlan().toString()
        assert n == ev.count()
        assert "skew=true" in p, p
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
