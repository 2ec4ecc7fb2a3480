"""Conform a DataFrame to a table contract: column order, types, defaults."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import NOW, TableContract


def load_time(loaded_at: dt.datetime | None) -> Column:
    """Audit time: the given instant, else the session-local current time."""
    if loaded_at is None:
        return F.localtimestamp()
    return ntz_literal(loaded_at)


def ntz_literal(t: dt.datetime) -> Column:
    """A wall-clock literal built from text: independent of the Python process's and
    the session's time zones (an aware value is first converted to UTC)."""
    if t.tzinfo is not None:
        t = t.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def with_columns(contract: TableContract, extra: list) -> TableContract:
    """The contract with further columns behind its own."""
    return replace(contract, columns=[*contract.columns, *extra])


def conform(df: DataFrame, contract: TableContract,
            loaded_at: dt.datetime | None = None) -> DataFrame:
    """Select the contract's columns in order, cast to its types; a missing column
    becomes its DEFAULT (``NOW`` = load time) or NULL. Extra columns are dropped."""
    now = load_time(loaded_at)
    cols = []
    for c in contract.columns:
        if c.name in df.columns:
            expr = F.col(c.name).cast(c.dtype)
        elif c.default == NOW:
            expr = now.cast(c.dtype)
        elif c.default is not None:
            expr = F.lit(c.default).cast(c.dtype)
        else:
            expr = F.lit(None).cast(c.dtype)
        cols.append(expr.alias(c.name))
    return df.select(*cols)
