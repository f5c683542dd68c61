"""Placement of data for joins: replicated small sides, hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

REPLICATE_BYTES = 32 << 20
REPLICATE_ROWS = 200_000


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan. For file scans it is the file
    size; filters do not lower it and joins multiply it, so it errs upwards."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _row_width(df: DataFrame) -> int:
    """Bytes Catalyst assumes for a row: twenty for a text and eight for other values."""
    return max(sum(20 if isinstance(f.dataType, StringType) else 8 for f in df.schema.fields), 1)


def replicate(df: DataFrame, max_bytes: int | None = None, rows_of: DataFrame | None = None) -> DataFrame:
    """Mark ``df`` for broadcast if its estimated size is within the bound; otherwise
    return it unmarked, so the join shuffles and adaptive execution splits skew.

    The estimate of a join multiplies both sides. Where ``df`` is a table joined to
    its parents by their unique key it has no more rows than that table, which is
    given as ``rows_of`` to be sized instead, with the columns ``df`` adds to it.
    """
    size = estimated_bytes(df)
    if rows_of is not None:
        wider = max(1.0, _row_width(df) / _row_width(rows_of))
        size = min(size, int(estimated_bytes(rows_of) * wider))
    bound = REPLICATE_BYTES if max_bytes is None else max_bytes
    return F.broadcast(df) if size <= bound else df


def replicate_counted(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The same for a stored or checkpointed frame, whose rows are cheap to count and
    whose estimate still carries that of its inputs."""
    bound = REPLICATE_ROWS if max_rows is None else max_rows
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def spread(df: DataFrame, tasks_per_core: int = 4) -> DataFrame:
    """Rows dealt evenly over all cores, before work that takes long for the bytes it reads: a
    file is cut by its bytes, so a small one with many rows would keep a single task busy."""
    return df.repartition(tasks_per_core * df.sparkSession.sparkContext.defaultParallelism)


def keys_of(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys, for semi and anti joins. Copies of a hot key are folded before
    the shuffle, and the join then reuses the shuffle of the distinct."""
    return df.select(*keys).distinct()


def many_to_one(facts: DataFrame, reference: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join facts to a reference with one row per key, made by grouping on that key.

    Adaptive execution splits a hot key only where a shuffle feeds the join on both
    sides; a grouped reference is already partitioned by the key and would be joined
    as it is. One more join column, a hash of the key, makes Spark shuffle the
    (small) reference once more, so the facts of a hot key are split over many tasks.
    """
    for key in on:
        types = facts.schema[key].dataType, reference.schema[key].dataType
        if types[0] != types[1]:
            # Equal values of different types have different hashes.
            raise ValueError(f"{key} is {types[0].simpleString()} here and {types[1].simpleString()} in the reference")
    mark = F.xxhash64(*on).alias("_key_hash")
    joined = facts.select("*", mark).join(reference.select("*", mark), [*on, "_key_hash"], how)
    return joined.drop("_key_hash")


def hot_keys(df: DataFrame, keys: Sequence[str], at_least_rows: int = 0, at_most_keys: int = 1000) -> DataFrame:
    """Keys with at least ``at_least_rows`` rows and at least one in ``at_most_keys`` of
    all rows, with their row counts. No more than ``at_most_keys`` keys can hold such a
    share, so the result is small whatever the data."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    all_rows = counted.agg(F.sum("n_rows")).scalar()
    return counted.where((F.col("n_rows") >= at_least_rows) & (F.col("n_rows") * at_most_keys >= all_rows))
