"""Keyed session state with last-write-wins and event-time expiry.

The state is an append-only log of items partitioned by ``batch_id`` (a retry of
a batch overwrites its own partition), plus views:

* ``latest_state``: one item per key (``user_id``, ``timestamp``), the one written
  last — highest (batch, sequence number, position in its batch);
* ``live_state``: the latest items whose ``ttl`` lies after ``as_of`` (expiry is
  by *event* time + 24 h, so a late event may arrive already expired; it is still
  written and merely hidden, as a TTL'd key-value store does);
* ``compact_state``: the rows worth keeping, for rewriting the log.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..operators.latest import latest_per_key
from ..schemas import STATE_KEY, STATE_SCHEMA

ITEM_COLUMNS = [f.name for f in STATE_SCHEMA.fields]
ORDER_COLUMNS = ["batch_id", "seq_len", "seq", "file_time", "source_file", "line", "pos"]
LOG_SCHEMA = T.StructType([
    *STATE_SCHEMA.fields, T.StructField("seq_len", T.IntegerType()), T.StructField("seq", T.StringType()),
    T.StructField("file_time", T.LongType()), T.StructField("source_file", T.StringType()),
    T.StructField("line", T.LongType()), T.StructField("pos", T.IntegerType()),
    T.StructField("batch_id", T.LongType())])


def write_order(seq: Column, source_file: Column, pos: Column,
                line: Column | None = None, file_time: Column | None = None) -> dict[str, Column]:
    """Columns that order writes inside a batch: a stream's sequence numbers are
    decimal strings of growing length, so (length, text) orders them numerically;
    without them, the time its file was written, the envelope's line in it, then the position
    in the envelope."""
    return {"seq_len": F.length(seq), "seq": seq, "source_file": source_file,
            "file_time": (file_time if file_time is not None else F.lit(0)).cast("bigint"),
            "line": (line if line is not None else F.lit(0)).cast("bigint"), "pos": pos}


def latest_state(log: DataFrame) -> DataFrame:
    """Last write per key; skew-safe (an aggregate, combined map side)."""
    return latest_per_key(log, STATE_KEY, ORDER_COLUMNS, tie=[],
                          cols=[c for c in ITEM_COLUMNS if c not in STATE_KEY])\
        .select(*ITEM_COLUMNS)


def epoch_seconds(as_of: dt.datetime | dt.date | int) -> int:
    if isinstance(as_of, int):
        return as_of
    if isinstance(as_of, dt.datetime):
        t = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
        return int(t.timestamp())
    return int(dt.datetime(as_of.year, as_of.month, as_of.day, tzinfo=dt.timezone.utc).timestamp())


def live_state(latest: DataFrame, as_of: dt.datetime | dt.date | int) -> DataFrame:
    """Items not yet expired at ``as_of`` (UTC when naive)."""
    return latest.where(F.col("ttl") > F.lit(epoch_seconds(as_of)))


def compact_state(log: DataFrame, as_of: dt.datetime | dt.date | int) -> DataFrame:
    """Log rows that still matter: the latest per key and not expired."""
    return live_state(latest_state(log), as_of)

