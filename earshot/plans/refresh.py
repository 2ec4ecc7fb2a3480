"""Incremental refresh of the marts and of the report's totals: what newer batches change.

They are kept in parts (``sinks.parts``) whose version is the newest batch they cover, so a
refresh reads only the fact's newer batches, a failed refresh shows nothing, and any number of
loads may lie between two refreshes. They hold keys and numbers; the dimensions' attributes are
joined when a mart is read, so they are always the current ones.

* Daily mart: a part per day. Distinct counts of a day can't be added up, so the days that newer
  batches have events of are counted anew from all of the day's events; other days stay.
* Skips of the report: a part per day, a row per (track, user); kept as the daily mart is.
* Track mart: a part per hash bucket of the track. Counts and sums of the newer batches are added to
  the stored ones. Listeners are exact: the pairs (track, user) met so far are a bucketed table, a
  refresh counts the pairs of the newer batches that it doesn't hold, and adds them. That table is
  joined where it lies: only the newer batches' pairs are shuffled, and each pair is a key of its
  own, so a track that a third of all events play is spread over all buckets.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.dates import date_key, months_back
from ..operators import marts, reports
from ..schemas import DIM_DATE, DIM_TRACKS, DIM_USERS
from ..session import hadoop_fs
from ..sinks import parts
from . import load as L
from .fact import read_fact

DAILY, TRACKS, LISTENERS = "mv_daily_user_summary", "mv_track_performance", "track_listeners"
SKIPS = "daily_skips"
TRACK_BUCKETS = 16              # parts of the track mart
PAIR_BUCKETS = 64               # of the (track, user) table: files of a bucket are one task's

_DAILY_SCHEMA = T.StructType([T.StructField("date_key", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in (
    "user_key", "unique_tracks", "sessions", "total_events", "plays", "skips", "completes", "duration"))])
_SKIPS_SCHEMA = T.StructType([T.StructField("date_key", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in (
    "track_key", "user_key", "skips", "duration", "n_duration"))])
_TRACK_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in (
    "track_key", "total_events", "completions", "skips", "duration", "n_duration", "unique_listeners")])
_ADDED = _TRACK_SCHEMA.fieldNames()[1:]


def covered(spark: SparkSession, warehouse: str, mart: str) -> int | None:
    """The newest batch that a mart (``DAILY``, ``TRACKS`` or ``SKIPS``) covers."""
    return parts.newest(spark, L.table_path(warehouse, mart))


def newer_events(spark: SparkSession, warehouse: str, mart: str) -> DataFrame | None:
    """Events of the batches that have committed since the mart's last refresh; None if there are none."""
    last, done = L.committed_batch(spark, warehouse), covered(spark, warehouse, mart)
    if last is None or (done is not None and done >= last):
        return None
    return read_fact(spark, warehouse, last, above=done)


def stale_days(spark: SparkSession, warehouse: str, mart: str = DAILY) -> list[int]:
    """Days (as date keys) whose rows in a mart kept by day lack events that have been loaded."""
    new = newer_events(spark, warehouse, mart)
    if new is None:
        return []
    days = new.where(F.col("date_key").isNotNull()).select("date_key").distinct()
    return sorted(r[0] for r in days.collect())                 # a row per day


def _refresh_days(spark: SparkSession, warehouse: str, name: str, totals: Callable[[DataFrame], DataFrame],
                  schema: T.StructType, sort_by: list[str], keep: int) -> int:
    """Recompute the days that batches since the last refresh have events of. Returns the table's rows."""
    root, last = L.table_path(warehouse, name), L.committed_batch(spark, warehouse)
    days = stale_days(spark, warehouse, name)
    if last is None or covered(spark, warehouse, name) == last:
        return sum(n for _, n in parts.manifest(spark, root).values())
    fact = read_fact(spark, warehouse, last).where(F.col("date_key").isin(days))        # prunes folders
    rows = totals(fact).select(*(F.col(f.name).cast(f.dataType) for f in schema))
    total = parts.replace_parts(rows, F.col("date_key").cast("bigint"), days, root, last, sort_by)
    parts.drop_unused(spark, root, keep)
    return total


def refresh_daily(spark: SparkSession, warehouse: str, keep: int = 3) -> int:
    """Bring the daily mart up to the newest committed batch. Returns its rows (user days)."""
    return _refresh_days(spark, warehouse, DAILY, marts.daily_totals, _DAILY_SCHEMA, ["user_key"], keep)


def refresh_skips(spark: SparkSession, warehouse: str, keep: int = 3) -> int:
    """Bring the skips per (day, track, user) up to the newest committed batch. Returns their rows."""
    return _refresh_days(spark, warehouse, SKIPS, reports.daily_skips, _SKIPS_SCHEMA, ["track_key", "user_key"], keep)


def rolling_report(spark: SparkSession, warehouse: str, as_of: dt.date | str | None = None, top: int = 10) -> DataFrame:
    """The report of the most-skipped tracks of the month before ``as_of`` (today if None), as of the last
    refresh of the skips. As the date moves on, days leave and enter what is read: only the folders
    of the month's days, never the fact."""
    date = dt.datetime.now(dt.timezone.utc).date() if as_of is None else as_of
    first = spark.range(1).select(date_key(months_back(reports.as_of_column(date), 1))).first()[0]
    root = L.table_path(warehouse, SKIPS)
    days = [d for d in parts.manifest(spark, root) if d >= first]
    per = parts.read_parts(spark, root, _SKIPS_SCHEMA, only=days).groupBy("track_key", "user_key").agg(
        *(F.sum(c).alias(c) for c in ("skips", "duration", "n_duration")))
    return reports.top_skipped(per, L.current_dim(spark, warehouse, "dim_tracks", DIM_TRACKS), top)


def read_daily(spark: SparkSession, warehouse: str) -> DataFrame:
    """The daily mart as of its last refresh, with the dimensions' present attributes."""
    per = parts.read_parts(spark, L.table_path(warehouse, DAILY), _DAILY_SCHEMA)
    return marts.daily_rows(per, L.current_dim(spark, warehouse, "dim_users", DIM_USERS),
                            L.current_dim(spark, warehouse, "dim_date", DIM_DATE))


def listeners_table(spark: SparkSession, warehouse: str) -> str:
    """Name of the bucketed table of the (track, user) pairs met so far, under the session's catalog;
    its files are the warehouse's."""
    path = L.table_path(warehouse, LISTENERS)
    name = f"track_listeners_{hashlib.md5(path.encode()).hexdigest()[:16]}"
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} (track_key BIGINT, user_key BIGINT, batch_id BIGINT) USING PARQUET
                  PARTITIONED BY (batch_id) CLUSTERED BY (track_key, user_key) INTO {PAIR_BUCKETS} BUCKETS
                  LOCATION '{path}'""")
    spark.catalog.refreshTable(name)
    return name


def new_pairs(spark: SparkSession, warehouse: str, events: DataFrame, done: int | None) -> DataFrame:
    """The (track, user) pairs of ``events`` that no batch up to ``done`` had."""
    pairs = events.where("track_key is not null and user_key is not null").select("track_key", "user_key").distinct()
    if done is None:
        return pairs
    held = spark.table(listeners_table(spark, warehouse)).where(F.col("batch_id") <= F.lit(int(done)))
    return pairs.join(held.hint("merge"), ["track_key", "user_key"], "left_anti")


def refresh_tracks(spark: SparkSession, warehouse: str, keep: int = 3) -> int:
    """Bring the track mart up to the newest committed batch. Returns its rows (tracks)."""
    root, last = L.table_path(warehouse, TRACKS), L.committed_batch(spark, warehouse)
    events, done = newer_events(spark, warehouse, TRACKS), covered(spark, warehouse, TRACKS)
    if events is None:
        return sum(n for _, n in parts.manifest(spark, root).values())
    name = listeners_table(spark, warehouse)
    # what a failed refresh of this batch may have left; pairs of other failed ones are true pairs, too
    fs, own = hadoop_fs(spark, f"{L.table_path(warehouse, LISTENERS)}/batch_id={int(last)}")
    fs.delete(own, True)
    (new_pairs(spark, warehouse, events, done).select("track_key", "user_key", F.lit(int(last)).cast("bigint").alias("batch_id"))
     .repartition(PAIR_BUCKETS, "track_key", "user_key").write.insertInto(name))
    spark.catalog.refreshTable(name)
    met = (spark.table(name).where(F.col("batch_id") == F.lit(int(last)))
           .groupBy("track_key").agg(F.count(F.lit(1)).alias("unique_listeners")))
    added = marts.track_totals(events).join(met, "track_key", "left").na.fill(0, ["unique_listeners"])
    place = parts.bucket("track_key", TRACK_BUCKETS)
    touched = [r[0] for r in events.where("track_key is not null").select(place).distinct().collect()]     # a row per bucket at most
    before = parts.read_parts(spark, root, _TRACK_SCHEMA, only=touched)
    merged = before.unionByName(added.select(_TRACK_SCHEMA.fieldNames())).groupBy("track_key").agg(
        *(F.sum(c).alias(c) for c in _ADDED))
    total = parts.replace_parts(merged, place, touched, root, last, ["track_key"])
    parts.drop_unused(spark, root, keep)
    return total


def read_tracks(spark: SparkSession, warehouse: str) -> DataFrame:
    """The track mart as of its last refresh, with the tracks' present titles and artists."""
    per = parts.read_parts(spark, L.table_path(warehouse, TRACKS), _TRACK_SCHEMA)
    return marts.track_rows(per, L.current_dim(spark, warehouse, "dim_tracks", DIM_TRACKS))
