"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.text import text_key
from lakeloom.session import checkpointed

# monotonically_increasing_id() holds the partition above this bit, the row below it.
_ROW_BITS = 33


def dense_keys(df: DataFrame, order_by: Sequence[str], name: str, first: int = 1) -> DataFrame:
    """Number all rows 1, 2, 3, ... in the order of ``order_by``, which must be unique.

    A window over the whole table would sort it in one task. Here rows are range
    partitioned and sorted in parallel, each partition is numbered on its own, and
    the start of each partition is added from a table with one row per partition.
    The ranges are checkpointed, so the counts and the rows see the same ones even
    after an executor is lost.
    """
    placed = checkpointed(
        df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", _ROW_BITS)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_part",
            F.coalesce(
                F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_start"),
        )
    )
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per partition of ``placed``: bounded by the number of shuffle partitions.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select((F.col("_start") + row + first).alias(name), *df.columns)
    )


def hashed_key(df: DataFrame, parts: Sequence[str | Column], name: str) -> DataFrame:
    """A key computed from each row alone: no shuffle, and the same on every run."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return df.withColumn(name, text_key(*columns))


def lasting_keys(batch: DataFrame, known: DataFrame | None, natural: Sequence[str], name: str, first: int = 1) -> DataFrame:
    """The map of natural keys to surrogate keys after a batch: ``natural`` columns and ``name``.

    Keys in ``known``, the map of earlier batches, keep their number for good. New ones are
    numbered on from the largest, in their own order, by ``dense_keys``, so no task sees them
    all; the same batch again adds nothing. Repeated rows are one key. A null part is a
    value like others, so a key of nulls has one number. Store the result and give it to the
    next batch; reading and writing one map at a time is up to the caller.
    """
    keys = batch.select(*natural).distinct()
    if known is None:
        return dense_keys(keys, natural, name, first).select(*natural, name)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in natural])
    there = known.select(*[F.col(k).alias(f"_known_{k}") for k in natural])
    new = keys.join(there, same, "left_anti")
    # One number.
    last = known.agg(F.max(name)).first()[0]
    numbered = dense_keys(new, natural, name, first if last is None else last + 1)
    return known.select(*natural, name).unionByName(numbered.select(*natural, name))
