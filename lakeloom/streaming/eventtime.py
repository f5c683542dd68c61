"""Loads in event time: each event once while it can still arrive, late ones kept apart.

Two streams run one after the other. The first sorts a delivery out by the watermark, the
latest event time of earlier deliveries less a delay: rows at or before it are late and go
to a table of their own, the others are handed on. The second folds copies with a state
that the watermark empties, so neither depends on how much was loaded before. What the
second receives is never behind its own watermark: it has seen no later times than the
first had when it let a row pass. So no row is lost between them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.session import tune
from lakeloom.sinks.files import write_parquet

DAY, REASON = "event_day", "reason"
LATE, TIMELESS = "late", "no time"


def _watermark_schema() -> str:
    return "batch bigint, newest timestamp"


def _sorted_out(batch: DataFrame, number: int, state: str, late: str, time: str, delay: timedelta) -> None:
    """One delivery: late rows apart, the others handed on, its latest time noted. All
    three are folders named by the delivery's number, so a repeated run replaces them."""
    spark = tune(batch.sparkSession)
    newest = batch.agg(F.max(time).alias("newest")).select(F.lit(number).cast("bigint").alias("batch"), "newest")
    write_parquet(newest, f"{state}/newest/batch-{number}", mode="overwrite")
    # One row for each delivery.
    seen = spark.read.schema(_watermark_schema()).parquet(f"{state}/newest/*")
    last = seen.where(F.col("batch") < number).agg(F.max(F.unix_millis("newest"))).first()[0]
    limit = F.lit(None if last is None else last - delay // timedelta(milliseconds=1)).cast("bigint")
    reason = F.when(F.col(time).isNull(), TIMELESS).when(F.unix_micros(time) <= limit * 1000, LATE)
    marked = batch.withColumn(REASON, reason)
    write_parquet(marked.where(F.col(REASON).isNotNull()), f"{late}/batch-{number}", mode="overwrite")
    write_parquet(marked.where(F.col(REASON).isNull()).drop(REASON), f"{state}/on_time/batch-{number}", mode="overwrite")


def load_in_event_time(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    late: str,
    state: str,
    keys: Sequence[str],
    time: str,
    delay: timedelta,
    pattern: str = "*.parquet",
    file_format: str = "parquet",
    files_per_batch: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Load the files of ``landing`` that no earlier call with the same ``state`` has loaded.

    Returns the accepted rows, each key once, and the late ones with their reason. A key's
    copies carry its time; those that arrive while the watermark has not passed it are
    folded, those after it are late. The watermark moves between deliveries, so rows of one
    delivery never make each other late. Rows without a time are kept with the late ones.
    A call that was cut short is finished by the next: deliveries have their own folders, and
    accepted rows are listed by the sink's own log, which ``accepted_rows`` follows.
    ``time`` is a timestamp column of ``schema``.
    """
    tune(spark)
    incoming = spark.readStream.format(file_format).schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if files_per_batch:
        incoming = incoming.option("maxFilesPerTrigger", files_per_batch)

    def sort_out(batch: DataFrame, number: int) -> None:
        # A delivery is read for its latest time and twice for its rows.
        batch.persist()
        try:
            _sorted_out(batch, number, state, late, time, delay)
        finally:
            batch.unpersist()

    first = incoming.load(landing).writeStream.foreachBatch(sort_out).option("checkpointLocation", f"{state}/sorting").trigger(availableNow=True).start()
    first.awaitTermination()
    on_time = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{state}/on_time")
    once = on_time.withWatermark(time, f"{delay // timedelta(milliseconds=1)} milliseconds").dropDuplicatesWithinWatermark(list(keys))
    second = (
        once.withColumn(DAY, F.to_date(time))
        .writeStream.format("parquet")
        .partitionBy(DAY)
        .option("checkpointLocation", f"{state}/folding")
        .option("path", target)
        .trigger(availableNow=True)
        .start()
    )
    second.awaitTermination()
    return accepted_rows(spark, target, schema), late_rows(spark, late, schema)


def accepted_rows(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """Rows the load has accepted, by the sink's log."""
    return spark.read.schema(StructType([*schema.fields]).add(DAY, "date")).parquet(target).select(*schema.fieldNames())


def late_rows(spark: SparkSession, late: str, schema: StructType) -> DataFrame:
    """Rows that came too late or without a time, every arrival, with the reason."""
    return spark.read.schema(StructType([*schema.fields]).add(REASON, "string")).parquet(f"{late}/batch-*")
