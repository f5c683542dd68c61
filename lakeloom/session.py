"""Session set-up and the shared scratch folder.

Nothing here assumes it owns the session: a session handed in by a cluster keeps
its own memory, parallelism and catalog settings, and only run-time SQL settings
that results or skew handling depend on are set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Results depend on the time zone and on errors for overflows and bad casts, which would
# turn into nulls without a word; the other settings let Spark re-plan skewed and
# badly estimated joins at run time, also where a later aggregate would otherwise
# make it keep the skewed partition to save a shuffle.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def initial_partitions(shuffle_partitions: int, parallelism: int) -> int:
    """Shuffle partitions to start with: several per core, so one fits into a task's
    memory and a slow one does not hold up the stage; adaptive execution merges them
    again where there is little data."""
    return max(shuffle_partitions, 4 * parallelism)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session, whoever created it."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    context = spark.sparkContext
    if not context.master.startswith("local") and spark.conf.get(_INITIAL_PARTITIONS, None) is None:
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(_INITIAL_PARTITIONS, str(initial_partitions(current, context.defaultParallelism)))
    return spark


def get_spark(app_name: str = "lakeloom", master: str | None = None, **settings: str) -> SparkSession:
    """Get or create a tuned session. ``settings`` use ``_`` for ``.`` in keys."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Only a local session may fall back to a
    temporary folder, because only there driver and executors share one disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        current = context.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/lakeloom/{label}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Reliable checkpoint in the shared folder: survives the loss of executors."""
    folder, context = shared_folder(df.sparkSession), df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
