"""Time expressions: epoch values, date parts, date keys, weekday conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Values each convention gives for Sunday and Monday (fixed values).
WEEKDAY_STYLES = {
    "monday0": (6, 0),
    "sunday0": (0, 1),
    "sunday1": (1, 2),
    "iso": (7, 1),
}


def weekday(c: Column, style: str = "monday0") -> Column:
    """Day of the week under one of the conventions in ``WEEKDAY_STYLES``."""
    if style == "monday0":
        return F.weekday(c)
    if style == "sunday0":
        return F.dayofweek(c) - 1
    if style == "sunday1":
        return F.dayofweek(c)
    if style == "iso":
        return F.weekday(c) + 1
    raise ValueError(f"unknown weekday style {style!r}; known: {sorted(WEEKDAY_STYLES)}")


def is_weekend(c: Column) -> Column:
    return weekday(c, "iso") >= 6


def epoch_seconds(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp in whole seconds."""
    return F.timestamp_seconds(F.floor(ms / 1000))


def epoch_millis(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp that keeps the fraction."""
    return F.timestamp_millis(ms.cast("bigint"))


def epoch_date(ms: Column) -> Column:
    return F.to_date(epoch_millis(ms))


def date_key(c: Column) -> Column:
    """Date as the integer yyyyMMdd."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def in_year(c: Column, year: int) -> Column:
    """The year test as a range on the bare column, which Parquet statistics can
    answer; ``year(c) = n`` would have to read every row group."""
    first, after = (F.to_timestamp_ntz(F.lit(f"{y:04d}-01-01 00:00:00")) for y in (year, year + 1))
    return (c >= first) & (c < after)


def in_month(c: Column, year: int, month: int) -> Column:
    """The same for one calendar month."""
    y2, m2 = (year + 1, 1) if month == 12 else (year, month + 1)
    first, after = (F.to_timestamp_ntz(F.lit(f"{y:04d}-{m:02d}-01 00:00:00")) for y, m in ((year, month), (y2, m2)))
    return (c >= first) & (c < after)


def date_parts(c: Column, weekday_style: str = "monday0") -> list[Column]:
    """Day, ISO week, month, quarter, year and weekday as aliased integers."""
    return [
        F.dayofmonth(c).alias("day"),
        F.weekofyear(c).alias("week"),
        F.month(c).alias("month"),
        F.quarter(c).alias("quarter"),
        F.year(c).alias("year"),
        weekday(c, weekday_style).alias("weekday"),
    ]
