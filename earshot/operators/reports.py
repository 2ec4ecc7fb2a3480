"""Reports over the star."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import date_key, months_back
from .marts import dim_date_side, safe_ratio


def as_of_column(as_of: dt.date | str | Column | None) -> Column:
    """Report date: a literal, or today when omitted."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of))


def most_skipped_tracks(fact: DataFrame, dim_tracks: DataFrame, dim_date: DataFrame,
                        as_of: dt.date | str | Column | None = None, top: int = 10) -> DataFrame:
    """Top tracks by skips in the calendar month before ``as_of`` (no upper bound).

    Groups by (title, artist), so track ids sharing both merge. Ties on the skip
    count are broken by title, then artist.

    Plan: the SKIP filter and ``date_key >= key(cutoff)`` reach the Parquet scan
    (the key is order-preserving, and the cutoff folds to a literal); the date
    dimension is broadcast; the fact is reduced to one row per (track, user)
    before it meets the track dimension; the top-k is a per-partition
    ``TakeOrderedAndProject``, not a global sort.
    """
    cutoff = months_back(as_of_column(as_of), 1)
    skips = fact.where((F.col("action") == F.lit("SKIP")) & (F.col("date_key") >= date_key(cutoff)))
    days = dim_date_side(dim_date.where(F.col("full_date") >= cutoff), ["date_key"])
    return top_skipped(skips.join(days, "date_key").groupBy("track_key", "user_key").agg(*skip_totals()), dim_tracks, top)


def skip_totals() -> list[Column]:
    """The additive numbers of a group of skips."""
    return [F.count(F.lit(1)).alias("skips"), F.sum("duration_ms").alias("duration"),
            F.count("duration_ms").alias("n_duration")]


def daily_skips(fact: DataFrame) -> DataFrame:
    """Per (date_key, track_key, user_key): the skips, from which the report of any days follows."""
    return (fact.where((F.col("action") == F.lit("SKIP")) & F.col("date_key").isNotNull() & F.col("track_key").isNotNull())
            .groupBy("date_key", "track_key", "user_key").agg(*skip_totals()))


def top_skipped(per: DataFrame, dim_tracks: DataFrame, top: int) -> DataFrame:
    """The report from totals per (track, user)."""
    tracks = dim_tracks.select("track_key", "title", "artist")
    report = (per.join(tracks, "track_key")
              .groupBy("title", "artist")
              .agg(F.sum("skips").alias("skip_count"),
                   F.round(safe_ratio(F.sum("duration"), F.sum("n_duration")) / F.lit(1000.0), 1)
                   .alias("avg_sec_before_skip"),
                   F.count_distinct("user_key").alias("unique_skippers")))
    return report.orderBy(F.desc("skip_count"), F.asc("title"), F.asc("artist")).limit(top)


def last_month(fact: DataFrame, dim_date: DataFrame,
               as_of: dt.date | str | Column | None = None) -> DataFrame:
    """Fact rows whose day lies on or after ``as_of`` minus one month, with the day."""
    cutoff = months_back(as_of_column(as_of), 1)
    days = dim_date_side(dim_date.where(F.col("full_date") >= cutoff), ["date_key", "full_date"])
    return fact.where(F.col("date_key") >= date_key(cutoff)).join(days, "date_key")
