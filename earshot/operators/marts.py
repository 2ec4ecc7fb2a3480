"""The two materialized marts over the star.

Both aggregate the fact by its surrogate keys *before* joining dimensions: the
join then sees one row per (day, user) or per track instead of one per event.
With unique dimension keys (checked by ``quality.check_pk``) the grouping by the
dimension attributes equals the grouping by their keys, so the result is the
same as joining first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .distinct import distinct_totals

DAILY_COLUMNS = ["full_date", "user_id", "subscription_tier", "total_events", "plays", "skips",
                 "completes", "total_minutes", "unique_tracks", "sessions"]
TRACK_COLUMNS = ["track_id", "title", "artist", "total_events", "completions", "skips",
                 "skip_rate", "avg_listen_seconds", "unique_listeners"]


def action_is(name: str) -> Column:
    return F.col("action") == F.lit(name)


def action_counts() -> list[Column]:
    """count(*) and the conditional counts (NULL action counts as no match)."""
    return [F.count(F.lit(1)).alias("total_events"),
            F.count_if(action_is("PLAY")).alias("plays"),
            F.count_if(action_is("SKIP")).alias("skips"),
            F.count_if(action_is("COMPLETE")).alias("completes")]


def minutes(total_ms: Column) -> Column:
    return total_ms / F.lit(1000.0) / F.lit(60.0)


def safe_ratio(num: Column, den: Column) -> Column:
    return num / F.nullif(den, F.lit(0))


def dim_date_side(dim_date: DataFrame, cols: list[str]) -> DataFrame:
    """The date dimension holds one row per calendar day — a proven size bound
    (36,525 rows per century) — so it is always broadcast."""
    return F.broadcast(dim_date.select(*cols))


def daily_totals(fact: DataFrame) -> DataFrame:
    """Per (date_key, user_key): what the daily mart holds, without the dimensions' attributes."""
    rows = fact.select("date_key", "user_key", "track_key", "session_id", "action", "duration_ms")
    return distinct_totals(rows, ["date_key", "user_key"], {"unique_tracks": "track_key", "sessions": "session_id"},
                           {"total_events": F.count(F.lit(1)), "plays": F.count_if(action_is("PLAY")),
                            "skips": F.count_if(action_is("SKIP")), "completes": F.count_if(action_is("COMPLETE")),
                            "duration": F.sum("duration_ms")})


def daily_rows(per: DataFrame, dim_users: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The daily mart from its totals."""
    users = dim_users.select("user_key", "user_id", "subscription_tier")
    return (per.join(users, "user_key")
            .join(dim_date_side(dim_date, ["date_key", "full_date"]), "date_key")
            .select("full_date", "user_id", "subscription_tier", "total_events", "plays", "skips",
                    "completes", minutes(F.col("duration")).alias("total_minutes"),
                    "unique_tracks", "sessions"))


def daily_user_summary(fact: DataFrame, dim_users: DataFrame, dim_date: DataFrame) -> DataFrame:
    return daily_rows(daily_totals(fact), dim_users, dim_date)


def track_totals(fact: DataFrame) -> DataFrame:
    """Per track_key: the additive part of the track mart."""
    return fact.where(F.col("track_key").isNotNull()).groupBy("track_key").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(action_is("COMPLETE")).alias("completions"),
        F.count_if(action_is("SKIP")).alias("skips"),
        F.sum("duration_ms").alias("duration"),
        F.count("duration_ms").alias("n_duration"))


def track_rows(per: DataFrame, dim_tracks: DataFrame) -> DataFrame:
    """The track mart from its totals and listeners."""
    tracks = dim_tracks.select("track_key", "track_id", "title", "artist")
    return (per.join(tracks, "track_key")
            .select("track_id", "title", "artist", "total_events", "completions", "skips",
                    F.round(safe_ratio(F.lit(100.0) * F.col("skips"), F.col("total_events")), 2)
                    .alias("skip_rate"),
                    (safe_ratio(F.col("duration"), F.col("n_duration")) / F.lit(1000.0))
                    .alias("avg_listen_seconds"),
                    "unique_listeners"))


def track_performance(fact: DataFrame, dim_tracks: DataFrame) -> DataFrame:
    per = fact.groupBy("track_key").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(action_is("COMPLETE")).alias("completions"),
        F.count_if(action_is("SKIP")).alias("skips"),
        F.sum("duration_ms").alias("duration"),
        F.count("duration_ms").alias("n_duration"),
        F.count_distinct("user_key").alias("unique_listeners"),
    )
    return track_rows(per, dim_tracks)
