"""SCD type 1 upsert of a dimension by key (MERGE ... UPDATE SET * / INSERT *).

Expressed as joins on the key. On a match the source's columns
replace the target's, columns the source lacks keep the target's value, and
``created_at`` is kept; ``updated_at`` is the load time for touched rows. New rows
get the contract's defaults for the columns the source lacks. ``combine`` gives
per-column rules for matched rows instead of plain replacement (for example
``least`` for a first-seen time), so that a replayed or older batch cannot move
history backwards.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import NOW, TableContract
from .conform import load_time

Combine = Callable[[Column, Column, Column, Column], Column]   # (target, source, t_row, s_row)


def upsert(target: DataFrame, source: DataFrame, contract: TableContract,
           combine: dict[str, Combine] | None = None,
           loaded_at: dt.datetime | None = None) -> DataFrame:
    """Merged table in the contract's column order. ``source`` must be unique on the
    key (check with ``quality.check_pk`` first).

    One full outer join on the key: the source (an aggregate) is planned once and the target read
    once. With sides of very different size the smaller one is shuffled with the larger.
    """
    return _merge_rows(target, source, contract, combine, loaded_at)


def _merge_rows(target: DataFrame, source: DataFrame, contract: TableContract,
                combine: dict[str, Combine] | None,
                loaded_at: dt.datetime | None) -> DataFrame:
    key = contract.key
    combine = combine or {}
    now = load_time(loaded_at)
    t = target.select(*[F.col(c).alias("t__" + c) for c in target.columns],
                      F.lit(True).alias("t__present"))
    s = source.select(*[F.col(c).alias("s__" + c) for c in source.columns],
                      F.lit(True).alias("s__present"))
    j = t.join(s, t["t__" + key] == s["s__" + key], "full_outer")
    in_t = F.col("t__present").isNotNull()
    in_s = F.col("s__present").isNotNull()
    cols = []
    for c in contract.columns:
        tc = F.col("t__" + c.name) if c.name in target.columns else F.lit(None).cast(c.dtype)
        if c.name == key:
            expr = F.coalesce(F.col("s__" + key), F.col("t__" + key))
        elif c.name == "created_at":
            expr = F.when(in_t, tc).otherwise(now)
        elif c.name == "updated_at":
            expr = F.when(in_s, now).otherwise(tc)
        elif c.name in source.columns:
            sc = F.col("s__" + c.name)
            if c.name in combine:
                merged = combine[c.name](tc, sc, F.col("t__present"), F.col("s__present"))
                expr = F.when(in_s & in_t, merged).when(in_s, sc).otherwise(tc)
            else:
                expr = F.when(in_s, sc).otherwise(tc)
        else:
            default = (now if c.default == NOW else
                       F.lit(c.default) if c.default is not None else F.lit(None))
            expr = F.when(in_t, tc).otherwise(default.cast(c.dtype))
        cols.append(expr.cast(c.dtype).alias(c.name))
    return j.select(*cols)


LAST_EVENT = "last_event"      # stored beside a track: time of the event its values come from


def track_rules() -> dict[str, Combine]:
    """A track's values follow its latest event (the source on equal times), in whatever order
    batches arrive."""
    def newer(t: Column, s: Column, *_: Column) -> Column:
        t_last, s_last = F.col("t__" + LAST_EVENT), F.col("s__" + LAST_EVENT)
        return F.when(t_last.isNull() | (s_last.isNotNull() & (s_last >= t_last)), s).otherwise(t)
    return {"title": newer, "artist": newer, LAST_EVENT: keep_latest}


def keep_earliest(t: Column, s: Column, *_: Column) -> Column:
    return F.least(t, s)


def keep_latest(t: Column, s: Column, *_: Column) -> Column:
    return F.greatest(t, s)


# Rules for the user dimension: first and latest activity survive any batch order;
# the device follows the later last_seen (the source on equal times).
USER_RULES: dict[str, Combine] = {
    "first_seen": keep_earliest,
    "last_seen": keep_latest,
}


def user_rules_with_device() -> dict[str, Combine]:
    rules = dict(USER_RULES)

    def device(t: Column, s: Column, *_: Column) -> Column:
        t_last, s_last = F.col("t__last_seen"), F.col("s__last_seen")
        return F.when(t_last.isNull() | (s_last.isNotNull() & (s_last >= t_last)), s).otherwise(t)

    rules["primary_device"] = device
    return rules
