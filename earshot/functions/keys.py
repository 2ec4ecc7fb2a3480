"""Surrogate keys derived from content.

A key is the first 15 hex digits (60 bits) of the md5 of a string, read as a
bigint. It is a pure function of the natural key, so

* every run, retry and executor produces the same key (no per-run counter),
* a fact row's dimension key can be computed from the event itself, without a
  join against a dimension that may hold billions of rows,
* SQL engines can reproduce it (``('0x' || substr(md5(s), 1, 15))::BIGINT``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

NULL_MARK = "\\N"     # stands for NULL inside a composite key string


def key60(col: Column | str) -> Column:
    """60-bit md5 key of one value; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 15), 16, 10).cast("bigint")


def epoch_micros(df: DataFrame, name: str, dtype: T.DataType | None = None) -> Column:
    """Microseconds since the epoch, independent of the session time zone.

    A ``timestamp_ntz`` is wall-clock time read as UTC; a ``timestamp`` is an instant.
    """
    dtype = dtype if dtype is not None else df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                F.col(name))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(name))
    return F.col(name)


def composite_text(parts: list[Column]) -> Column:
    """Join values with '|'; NULL becomes a marker (concat_ws alone would skip it).

    Backslash and '|' inside a value are escaped, so different lists of values never give
    one text (the marker is a backslash that no escape produces).
    """
    def text(p: Column) -> Column:
        escaped = F.replace(F.replace(p.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        return F.coalesce(escaped, F.lit(NULL_MARK))
    return F.concat_ws("|", *map(text, parts))


def content_parts(df: DataFrame, fields: list[str]) -> list[Column]:
    out = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for f in fields:
        dtype = types[f]
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            out.append(epoch_micros(df, f, dtype))
        else:
            out.append(F.col(f))
    return out


def content_key(df: DataFrame, fields: list[str], arrival: str | None = None) -> Column:
    """Key over the content of a row plus an optional arrival identifier.

    The arrival identifier (event id, file+row index, stream sequence number) makes
    exact copies distinct without a shuffle; without it, copies share a key.
    """
    parts = content_parts(df, fields)
    if arrival is not None:
        parts.append(F.col(arrival))
    return key60(composite_text(parts))
