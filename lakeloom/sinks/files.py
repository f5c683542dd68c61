"""File writers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Takes the frame that goes to the writer and returns it, measured (``operators.quality.Observed``).
Watch = Callable[[DataFrame], DataFrame]


def write_parquet(
    df: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None, watch: Watch | None = None
) -> None:
    writer = (watch(df) if watch else df).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    mode: str = "errorifexists",
    sort_by: Sequence[str] = (),
    replace_only_present: bool = False,
    watch: Watch | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Parquet in one folder per value of ``by``.

    The rebalance hint groups rows by folder before the write, so a folder gets few
    files rather than one per task, and splits a folder that is far larger than the
    others over several tasks. ``replace_only_present`` overwrites the folders that
    occur in ``df`` and leaves all others.
    """
    placed = df.hint("rebalance", *by)
    if sort_by:
        placed = placed.sortWithinPartitions(*by, *sort_by)
    writer = (watch(placed) if watch else placed).write.options(**(options or {})).partitionBy(*by)
    if replace_only_present:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).parquet(path)


def write_sorted(df: DataFrame, path: str, order_by: Sequence[str], mode: str = "errorifexists") -> None:
    """Parquet in global order of ``order_by``, in files of about equal size: filters on
    a prefix of the order skip most row groups by their statistics."""
    df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).write.mode(mode).parquet(path)


def write_csv(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "errorifexists", multi_line: bool = False, **options
) -> None:
    """CSV with a header and every field quoted. Quotes inside a field are doubled. A line
    break in a text is an error, because plain readers split the record there, unless
    ``multi_line`` says that it will be read with the same argument."""
    chosen = df.select(*columns) if columns else df
    if not multi_line:
        broken = F.raise_error(F.lit("a text holds a line break; write and read it with multi_line=True")).cast("string")
        texts = [f.name for f in chosen.schema.fields if isinstance(f.dataType, StringType)]
        chosen = chosen.withColumns({c: F.when(F.col(c).rlike("[\\r\\n]"), broken).otherwise(F.col(c)) for c in texts})
    # White space at the ends of a text is part of it; the writer would cut it off.
    exact = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    chosen.write.mode(mode).options(header=True, quoteAll=True, quote='"', escape='"', **exact, **options).csv(path)


def write_documents(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON document per row."""
    df.write.mode(mode).json(path)
