"""Replacement of single partition folders of a stored Parquet table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.upsert import insert_ignore, upsert
from lakeloom.sinks.files import write_partitioned
from lakeloom.sinks.storage import Folders

SIDE, DONE, OLD = "_replacing", "_written", "_old"


def finish_replacement(spark: SparkSession, target: str) -> None:
    """Move in the folders of a replacement that was written whole, drop one that was not.
    Folders already moved are no longer at the side, so this may run again at any point. An
    old folder goes only after the new one is in its place."""
    target, folders = target.rstrip("/"), Folders(spark, target)
    side = f"{target}/{SIDE}"
    if folders.exists(f"{side}/{DONE}"):
        for name, path in folders.folders(side).items():
            if name != OLD:
                folders.make(f"{side}/{OLD}")
                folders.replace(path, f"{target}/{name}", f"{side}/{OLD}/{name}")
    # A folder whose old form is still aside, with nothing in its place, was in between.
    for name, path in folders.folders(f"{side}/{OLD}").items():
        if not folders.exists(f"{target}/{name}"):
            folders.move(path, f"{target}/{name}")
    folders.delete(side)


def replace_folders(rows: DataFrame, target: str, partition: str, sort_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> None:
    """Replace the folders of ``partition`` that occur in ``rows``, leaving all others. All
    new folders are written at the side before the first old one goes."""
    spark = rows.sparkSession
    side = f"{target.rstrip('/')}/{SIDE}"
    write_partitioned(rows, side, [partition], sort_by=sort_by, options=options)
    Folders(spark, target).write_text(f"{side}/{DONE}", "")
    finish_replacement(spark, target)


def apply_upsert(
    target: str, batch: DataFrame, keys: Sequence[str], partition: str, order_by: Sequence[str] = (), update: Sequence[str] | None = None
) -> None:
    """Insert the rows of ``batch`` into a stored table of one folder for each value of
    ``partition``, which belongs to the key, so a row never changes its folder.

    With ``update`` these columns of rows already there take the batch's values; without it
    rows already there stay as they are. Only the folders that the batch touches are read
    and written, so the cost follows the batch. Running the same batch again changes nothing,
    and a run that was cut short is brought to its end, or undone, by the next."""
    if partition not in keys:
        raise ValueError("the partition column must be one of the keys")
    spark = batch.sparkSession
    finish_replacement(spark, target)
    # One value for each folder the batch touches.
    values = [row[0] for row in batch.select(partition).distinct().collect()]
    stored = spark.read.schema(batch.schema).parquet(target).where(F.col(partition).isin([v for v in values if v is not None]) | (F.col(partition).isNull() if None in values else F.lit(False)))
    merged = insert_ignore(stored, batch, keys, order_by) if update is None else upsert(stored, batch, keys, update, order_by)
    replace_folders(merged.select(*batch.columns), target, partition)
