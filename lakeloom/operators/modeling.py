"""Normal forms, denormalised tables and dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.times import date_key, epoch_millis, is_weekend, weekday
from lakeloom.operators.layout import replicate_counted
from lakeloom.operators.numbering import dense_keys


def first_normal_form(df: DataFrame, array: str, item: str, position: str | None = None) -> DataFrame:
    """One row per element of an array column."""
    kept = [c for c in df.columns if c != array]
    exploded = df.select(*kept, F.posexplode(array).alias("_pos", item))
    return exploded.select(*kept, *([F.col("_pos").alias(position)] if position else []), item)


def second_normal_form(
    df: DataFrame, key: str, item: str, item_key: str, position: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split a repeating column off: parents without it, and children with an id each,
    in the order of parent and position (or parent and item)."""
    parents = df.drop(item, *([position] if position else [])).distinct()
    order = [key, position or item]
    children = dense_keys(df.select(*dict.fromkeys([key, *order, item])), order, item_key)
    return parents, children.select(item_key, item, key)


def third_normal_form(df: DataFrame, attribute: str, attribute_key: str) -> tuple[DataFrame, DataFrame]:
    """Move an attribute to a table of its own; rows keep a reference to it.

    The attribute table is sent to every task only if it was counted and is small;
    otherwise it is joined by shuffle.
    """
    values = dense_keys(df.select(attribute).where(F.col(attribute).isNotNull()).distinct(), [attribute], attribute_key)
    rows = df.join(replicate_counted(values), attribute, "left")
    return rows.select(*[attribute_key if c == attribute else c for c in df.columns]), values


def rebuild(rows: DataFrame, values: DataFrame, attribute_key: str, columns: Sequence[str]) -> DataFrame:
    """Join a split-off attribute back."""
    return rows.join(replicate_counted(values), attribute_key, "left").select(*columns)


def date_dimension(df: DataFrame, time: str) -> DataFrame:
    """One row per calendar date that occurs, with its parts and a yyyyMMdd key."""
    day = F.col("date")
    return (
        df.select(F.to_date(time).alias("date"))
        .where(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.weekofyear(day).alias("week"),
            is_weekend(day).alias("is_weekend"),
        )
    )


def time_dimension(df: DataFrame, epoch_ms: str, weekday_style: str = "monday0") -> DataFrame:
    """One row per event time that occurs, from hour to year."""
    start = F.col("start_time")
    return (
        df.select(epoch_millis(F.col(epoch_ms)).alias("start_time"))
        .where(start.isNotNull())
        .distinct()
        .select(
            start,
            F.hour(start).alias("hour"),
            F.dayofmonth(start).alias("day"),
            F.weekofyear(start).alias("week"),
            F.month(start).alias("month"),
            F.year(start).alias("year"),
            weekday(start, weekday_style).alias("weekday"),
        )
    )


def entity_dimension(
    rows: DataFrame, natural_key: str, surrogate: str, attributes: Mapping[str, str | Column], as_of: str | None = None
) -> DataFrame:
    """A flattened dimension with a dense key. With ``as_of`` rows are valid from that
    date and have no end yet."""
    columns = [F.col(natural_key)] + [
        (F.col(c) if isinstance(c, str) else c).alias(name) for name, c in attributes.items() if name != natural_key
    ]
    dim = dense_keys(rows.select(*columns), [natural_key], surrogate)
    if as_of:
        dim = dim.withColumn("start_date", F.lit(as_of).cast("date")).withColumn("end_date", F.lit(None).cast("date"))
    return dim
