"""Dimensions built from a batch of events: date, track, user."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import calendar_columns
from ..functions.keys import key60
from .latest import first_last_per_key, latest_per_key
from .merge import LAST_EVENT

DIM_DATE_COLUMNS = ["full_date", "date_key", "day_of_week", "day_name", "month", "month_name",
                    "quarter", "year", "is_weekend"]


def default_tie(events: DataFrame, arrival: str | None = None) -> list[str]:
    """Tie-break for equal event times: arrival id if known, else the other event fields."""
    if arrival and arrival in events.columns:
        return [arrival]
    return [c for c in ("user_id", "session_id", "track_id", "track_title", "artist", "action",
                        "device_type", "listen_duration_ms") if c in events.columns]


def dim_date(events: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Distinct calendar days of the events with their attributes.

    NULL dates are dropped (the table forbids them). The distinct is combined map
    side: every task sends at most one row per day through the shuffle.
    """
    days = (events.select(F.to_date(F.col(ts)).alias("full_date"))
            .where(F.col("full_date").isNotNull()).distinct())
    return days.withColumns(calendar_columns("full_date")).select(*DIM_DATE_COLUMNS)


def dim_tracks(events: DataFrame, tie: list[str] | None = None,
               arrival: str | None = None, with_time: bool = False) -> DataFrame:
    """Latest title and artist per track id, with the content-derived ``track_key``;
    ``with_time`` adds the time of the event they come from."""
    tie = tie if tie is not None else default_tie(events, arrival)
    latest = latest_per_key(events.where(F.col("track_id").isNotNull()), ["track_id"],
                            ["event_timestamp"], tie, cols=["track_title", "artist", "event_timestamp"])
    time = [F.col("event_timestamp").alias(LAST_EVENT)] if with_time else []
    return latest.select(key60("track_id").alias("track_key"), "track_id",
                         F.col("track_title").alias("title"), "artist", *time)


def dim_users(events: DataFrame, tie: list[str] | None = None,
              arrival: str | None = None) -> DataFrame:
    """First and latest activity per user and the device of the latest event."""
    tie = tie if tie is not None else default_tie(events, arrival)
    per = first_last_per_key(events.where(F.col("user_id").isNotNull()), "user_id",
                             "event_timestamp", "device_type", tie)
    return per.select(key60("user_id").alias("user_key"), "user_id", "first_seen", "last_seen",
                      F.col("latest_device_type").alias("primary_device"))
