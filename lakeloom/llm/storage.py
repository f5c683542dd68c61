"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeloom.session import scratch_path
from lakeloom.sinks.storage import Folders


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it again: what builds on it does not
    compute it twice and does not depend on the executors that wrote it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: all that was built on them has been
    stored itself."""
    for df in frames:
        Folders(df.sparkSession, df._stored_at).delete(df._stored_at)
