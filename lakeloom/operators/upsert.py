"""Insert with key conflicts, as joins over Parquet tables.

The results are new frames. Write them to a new path and swap; a path cannot be
overwritten while it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.dedup import last_write_wins, one_per_key
from lakeloom.operators.layout import keys_of


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``, the first one per key."""
    fresh = one_per_key(batch, keys, order_by)
    return fresh.join(keys_of(target, *keys), list(keys), "left_anti").select(*batch.columns)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """All rows of ``target`` and the rows of ``batch`` with new keys."""
    return target.unionByName(new_rows(target, batch, keys, order_by))


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], update: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """New keys are inserted whole; known keys take ``update`` from the last row of the
    batch and keep their other columns."""
    last = last_write_wins(batch, keys, order_by).select(*target.columns)
    renamed = last.select(
        *[F.col(k) for k in keys],
        *[F.col(c).alias(f"_new_{c}") for c in target.columns if c not in keys],
        F.lit(True).alias("_in_batch"),
    )
    old = target.withColumn("_in_target", F.lit(True))
    joined = old.join(renamed, list(keys), "full_outer")
    columns = []
    for c in target.columns:
        if c in keys:
            columns.append(F.col(c))
        elif c in update:
            columns.append(F.when(F.col("_in_batch"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.when(F.col("_in_target"), F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c))
    return joined.select(*columns)
