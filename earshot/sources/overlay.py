"""Listening events derived from the driver's test tables (``events`` ⋈ ``part``).

Used by the registered queries and the tests; the library itself reads real
event files through ``sources.files``. The mapping is a fixed rule so the same
events can be rebuilt in SQL for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import DEVICE_TYPES
from ..session import is_broadcast

# ---- fixed values: test-table mapping ----------------------------------------------
# event_type -> action
ACTION_OF_TYPE = {"view": "PLAY", "signup": "PLAY", "click": "PAUSE", "error": "SKIP",
                  "purchase": "COMPLETE"}
# part key of a track title: k + PART_STRIDE * (event_id % 2), so most tracks get two titles
PART_STRIDE = 100
# -------------------------------------------------------------------------------------

ROW = "_row"      # the column by which rows are dealt out


_READ: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver test table; the read (file listing, footer) is reused per session —
    the tables are read-only."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark._jsparkSession.hashCode(), path)
    if key not in _READ:
        _READ[key] = spark.read.parquet(path)
    return _READ[key]


def _action(event_type: Column) -> Column:
    expr = None
    for t, a in ACTION_OF_TYPE.items():
        expr = (F.when(event_type == F.lit(t), F.lit(a)) if expr is None
                else expr.when(event_type == F.lit(t), F.lit(a)))
    return expr


def listening_events(spark: SparkSession, sf_dir: str,
                     deal: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """``event_id`` (arrival order) plus the nine event fields.

    ``event_timestamp`` keeps the table's ``timestamp_ntz`` (UTC wall clock). ``deal`` may move rows to other
    tasks by a column that differs from row to row (a hash of file and row index): one split of ``events`` may
    hold them all. They are dealt as they are read where ``part`` is broadcast, else after the join, which
    moves them by track; their fields are written after that in any case.
    """
    ev = table(spark, sf_dir, "events")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    if deal:
        row = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(ROW)
        ev = ev.select("event_id", "ts", "event_type", "value", "user_id", "props", row)
    early = deal and is_broadcast(part)
    if early:
        ev = deal(ev, ROW)
    k = F.get_json_object("props", "$.k").cast("bigint")
    base = ev.select(
        "event_id", "ts", "event_type", "value",
        F.col("user_id").alias("uid"), k.alias("k"),
        (k + F.lit(PART_STRIDE) * (F.col("event_id") % 2)).alias("part_key"),
        *([ROW] if deal and not early else []),
    )
    joined = base.join(part, base["part_key"] == part["p_partkey"], "left")
    if deal and not early:
        joined = deal(joined, ROW)
    action = _action(F.col("event_type"))
    devices = F.array(*[F.lit(d) for d in DEVICE_TYPES])
    return joined.select(
        "event_id",
        F.concat(F.lit("user_"), F.lpad(F.col("uid").cast("string"), 5, "0")).alias("user_id"),
        F.concat(F.lit("sess_"), F.col("uid").cast("string"), F.lit("_"),
                 F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.concat(F.lit("t"), F.lpad(F.col("k").cast("string"), 3, "0")).alias("track_id"),
        F.col("p_name").alias("track_title"),
        F.col("p_brand").alias("artist"),
        action.alias("action"),
        F.element_at(devices, (F.col("event_id") % 5 + 1).cast("int")).alias("device_type"),
        F.when(action == F.lit("PLAY"), F.lit(0))
         .otherwise(F.round(F.col("value") * F.lit(1000)).cast("int")).alias("listen_duration_ms"),
        F.col("ts").alias("event_timestamp"),
    )
