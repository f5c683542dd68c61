"""Access logs: parse, type, rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import LOG_FIELDS, LOG_TIME, log_fields, log_map, zero_for_dash


def parse_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Nine text columns, typed size, typed time, and ``corrupt`` with the whole line
    where it has another shape (all else is null then)."""
    fields = lines.withColumn("_f", log_fields(F.col(line)))
    named = fields.select(
        *[c for c in lines.columns if c != line],
        *[F.get("_f", F.lit(i)).alias(name) for i, name in enumerate(LOG_FIELDS)],
        F.when(F.col("_f").isNull(), F.col(line)).alias("corrupt"),
    )
    return (
        named.withColumn("content_size", zero_for_dash(F.col("content_size")))
        .withColumn("content_size_bytes", F.col("content_size").try_cast("bigint"))
        .withColumn("time", F.try_to_timestamp("date_time", F.lit(LOG_TIME)))
    )


def parse_log_map(lines: DataFrame, line: str = "value") -> DataFrame:
    """The fields as one map column ``parsed``; null for a malformed line."""
    return lines.withColumn("parsed", log_map(F.col(line)))


def top_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; ties go by value."""
    # Nulls are dropped after counting: a filter before it would be merged into the
    # expression behind the column and compute that twice.
    counted = df.groupBy(column).agg(F.count(column).alias("n_rows")).where(F.col("n_rows") > 0)
    return counted.orderBy(F.desc("n_rows"), column).limit(n)


def largest_responses(logs: DataFrame, n: int, ties: tuple[str | Column, ...] = ("endpoint", "host", "date_time")) -> DataFrame:
    """Ranked by size as a number; as text '9' would beat '10'."""
    return logs.orderBy(F.desc_nulls_last("content_size_bytes"), *ties).limit(n).select("endpoint", "content_size_bytes")
