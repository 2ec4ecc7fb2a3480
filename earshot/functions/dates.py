"""Calendar attributes of a date (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(col: Column | str) -> Column:
    """yyyyMMdd as an int; order-preserving, so range filters on it equal ones on the date."""
    day = F.to_date(_c(col))
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_of_week(col: Column | str) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(col))


def day_name(col: Column | str) -> Column:
    return F.date_format(_c(col), "EEEE")


def month_name(col: Column | str) -> Column:
    return F.date_format(_c(col), "MMMM")


def is_weekend(col: Column | str) -> Column:
    return F.when(F.dayofweek(_c(col)).isin(1, 7), F.lit(True)).otherwise(F.lit(False))


def months_back(as_of: Column, months: int = 1) -> Column:
    """Same day ``months`` earlier; clamps to month end (Mar 31 -> Feb 29)."""
    return F.add_months(as_of, -months)


def calendar_columns(col: Column | str) -> dict[str, Column]:
    d = _c(col)
    return {
        "date_key": date_key(d),
        "day_of_week": day_of_week(d),
        "day_name": day_name(d),
        "month": F.month(d),
        "month_name": month_name(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "is_weekend": is_weekend(d),
    }
