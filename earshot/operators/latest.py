"""Latest row per key (row_number() over (partition by key order by t desc) = 1).

Written as one aggregate, ``max_by(struct(payload), struct(order..., tie...))``.
The aggregate combines on the map side, so a key that holds a third of all rows
still sends one partial row per input partition through the shuffle; the window
form would sort all of that key's rows in one task.

A struct-valued ``max_by`` has no fixed-width buffer, so Spark runs it as a
sort-based aggregate: each task sorts its own split (spilling if needed) and emits
one row per key. The hash-only alternative — ``max(t)`` per key, then a join back
to the rows at that time — would shuffle every row a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str],
                   tie: list[str] | None = None, cols: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``(order..., tie...)``.

    ``tie`` breaks equal ``order`` values deterministically; when omitted, all other
    columns are used, so the result never depends on input order. NULL order values
    lose against non-NULL ones (as ``ORDER BY .. DESC NULLS LAST``).
    """
    cols = cols or [c for c in df.columns if c not in keys]
    if tie is None:
        tie = [c for c in df.columns if c not in keys and c not in order]
    ordering = F.struct(*[F.col(c) for c in order + [t for t in tie if t not in order]])
    picked = F.max_by(F.struct(*[F.col(c) for c in cols]), ordering).alias("_latest")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("_latest." + c).alias(c) for c in cols])


def first_last_per_key(df: DataFrame, key: str, ts: str, value: str,
                       tie: list[str] | None = None) -> DataFrame:
    """``min(ts)``, ``max(ts)`` and ``value`` at the latest ``(ts, tie)`` in one aggregate."""
    tie = tie or []
    ordering = F.struct(F.col(ts), *[F.col(t) for t in tie])
    return df.groupBy(key).agg(
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"),
        F.max_by(F.col(value), ordering).alias("latest_" + value),
    )
