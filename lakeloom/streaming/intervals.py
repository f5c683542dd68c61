"""Reload of one time interval."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.sinks.files import write_partitioned
from lakeloom.sinks.storage import Folders
from lakeloom.streaming.incremental import day_folders


def load_interval(df: DataFrame, time: str, start: date, end: date, target: str, day_column: str = "event_day") -> None:
    """Replace the days from ``start`` up to, not including, ``end`` by the rows of
    ``df`` in that interval; a day without rows there is empty afterwards. Days outside
    the interval stay as they are, so running the same interval again changes nothing.

    Days with rows are replaced first, then the folders of the others are removed; a run
    that was cut short can simply run again."""
    if start >= end:
        raise ValueError("start must be before end")
    first, after = (F.lit(d.isoformat()).cast(df.schema[time].dataType) for d in (start, end))
    rows = df.where((F.col(time) >= first) & (F.col(time) < after)).withColumn(day_column, F.to_date(time))
    write_partitioned(rows, target, [day_column], replace_only_present=True)
    # One value for each day of the interval at most.
    filled = {f"{day_column}={row[0]}" for row in rows.select(day_column).distinct().collect()}
    days = {f"{day_column}={start + timedelta(days=i)}" for i in range((end - start).days)}
    spark = df.sparkSession
    for name, path in day_folders(spark, target).items():
        if name in days - filled:
            Folders(spark, target).delete(path)
