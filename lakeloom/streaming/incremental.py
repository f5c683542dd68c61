"""Incremental load of event files into a fact table, each event once."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.operators.dedup import one_per_key
from lakeloom.session import tune
from lakeloom.sinks.files import write_partitioned
from lakeloom.sinks.storage import Folders

DAY, LOAD = "event_day", "load_id"


def _stored(spark: SparkSession, target: str, schema: StructType, folders: Sequence[str] = ()) -> DataFrame:
    wide = StructType([*schema.fields]).add(DAY, "date").add(LOAD, "string")
    return spark.read.schema(wide).option("basePath", target).parquet(*(folders or [target]))


def day_folders(spark: SparkSession, target: str) -> dict[str, str]:
    """Path by name of the day folders ``target`` has: one listing, one entry per day."""
    return Folders(spark, target).folders(target)


def add_batch(
    batch: DataFrame, target: str, load_id: str, keys: Sequence[str], time: str, order_by: Sequence[str | Column]
) -> None:
    """Add the events of ``batch`` that ``target`` does not hold.

    Copies within the batch are folded before the shuffle. Copies from earlier loads
    are looked up only in the days the batch touches (copies of an event carry the
    same time), so the cost follows the batch, not the table. The rows of a load have
    their own folders, which a repeated run of the same load replaces: a load that
    was cut short can simply run again.
    """
    spark = batch.sparkSession
    fresh = one_per_key(batch, keys, order_by).withColumn(DAY, F.to_date(time))
    folders = day_folders(spark, target)
    if folders:
        # One value per calendar day in the batch. Only the folders of these days are
        # listed and read.
        days = [row[0] for row in batch.select(F.to_date(time)).distinct().collect()]
        names = [f"{DAY}={day or '__HIVE_DEFAULT_PARTITION__'}" for day in days]
        touched = [folders[name] for name in names if name in folders]
        if touched:
            known = _stored(spark, target, batch.schema, touched).where(F.col(LOAD) != load_id)
            fresh = fresh.join(known.select(*keys), list(keys), "left_anti")
    rows = fresh.select(*batch.columns, DAY).withColumn(LOAD, F.lit(load_id))
    write_partitioned(rows, target, [DAY, LOAD], replace_only_present=True)


def load_new_files(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    time: str,
    order_by: Sequence[str | Column] | None = None,
    pattern: str = "*.parquet",
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Load the files of ``landing`` that no earlier call with the same ``checkpoint``
    has loaded, then stop. Returns the fact table.

    With ``archive`` loaded files are moved there, so ``landing`` stays short to list.
    """
    reader = spark.readStream.format(file_format).schema(schema).option("pathGlobFilter", pattern)
    reader = reader.option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    # Batch ids start again with a new checkpoint, so the load id names both.
    source = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, batch_id: int) -> None:
        tune(batch.sparkSession)
        add_batch(batch, target, f"{source}-{batch_id}", keys, time, order_by or [time])

    query = (
        reader.load(landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return fact_rows(spark, target, schema)


def compact_days(spark: SparkSession, target: str, schema: StructType, before: date) -> int:
    """Merge the folders that loads left in each day before ``before`` into one, and return
    the number of days merged. Rows stay the same; days with one folder are left alone.

    Merged rows are written to a side folder with a list of the folders they come from, which
    are then moved aside, the merged one moved in, and only then the old ones deleted. A run
    that was cut short is first brought to its end by the next one. No load should add to
    these days meanwhile, and readers should wait: between the moves a day is not there.
    """
    target, side = target.rstrip("/"), f"{target.rstrip('/')}/_compact"
    folders = Folders(spark, target)

    def finish() -> None:
        for day, folder in folders.folders(side).items():
            if folders.exists(f"{folder}/_sources"):
                old = f"{folder}/_old"
                folders.make(old)
                for name in folders.read_text(f"{folder}/_sources").split("\n"):
                    if folders.exists(f"{target}/{day}/{name}"):
                        folders.move(f"{target}/{day}/{name}", f"{old}/{name}")
                for name, merged in folders.folders(folder).items():
                    if name != "_old":
                        folders.move(merged, f"{target}/{day}/{name}")
        folders.delete(side)

    finish()
    days = {n: p for n, p in day_folders(spark, target).items() if n.startswith(f"{DAY}=") and n.removeprefix(f"{DAY}=") < before.isoformat()}
    loads = {day: day_folders(spark, path) for day, path in days.items()}
    many = {day: found for day, found in loads.items() if len(found) > 1}
    if many:
        rows = _stored(spark, target, schema, [path for found in many.values() for path in found.values()])
        write_partitioned(rows.withColumn(LOAD, F.lit(f"merged-{uuid.uuid4().hex}")), side, [DAY, LOAD])
        for day, found in many.items():
            folders.write_text(f"{side}/{day}/_sources", "\n".join(found))
        finish()
    return len(many)


def fact_rows(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The loaded events, without the load columns."""
    return _stored(spark, target, schema).select(*schema.fieldNames())
