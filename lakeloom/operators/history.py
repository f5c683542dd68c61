"""Dimension rows with the time for which they hold."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.dedup import one_per_key

START, END = "start_date", "end_date"


def first_history(batch: DataFrame, key: str, attributes: Sequence[str], as_of: date) -> DataFrame:
    """The history that begins with ``batch``: one open row for each key."""
    rows = one_per_key(batch.where(F.col(key).isNotNull()).select(key, *attributes), [key])
    return rows.withColumn(START, F.lit(as_of.isoformat()).cast("date")).withColumn(END, F.lit(None).cast("date"))


def merge_history(
    history: DataFrame, batch: DataFrame, key: str, attributes: Sequence[str], as_of: date, whole: bool = False
) -> DataFrame:
    """The history after a batch that holds from ``as_of`` on.

    A key whose attributes differ from its open row gets that row closed at ``as_of`` and a
    new one opened there; a key not seen before, or closed before, gets a first row. With
    ``whole`` the batch is a full list, and keys it lacks are closed. A row holds from its
    start up to, not including, its end, so the rows of a key neither overlap nor leave a
    gap while it is known. A second change on one day replaces the first, and the same
    batch again changes nothing. A batch older than an open row of a key in it is refused
    while the rows are read, because what it should close is no longer open.

    Rows of ``batch`` with a null key are left out; of a repeated key the least row counts.
    Only open rows meet the batch; closed ones pass through without a shuffle.
    """
    day = F.lit(as_of.isoformat()).cast("date")
    open_row = F.col(END).isNull()
    new = one_per_key(batch.where(F.col(key).isNotNull()).select(key, *attributes), [key])
    new = new.select(F.col(key).alias("_key"), F.struct(*attributes).alias("_new"))
    old = history.where(open_row).select(key, START, F.struct(*attributes).alias("_old"))
    met = old.join(new, F.col(key) == F.col("_key"), "full_outer")
    refused = F.raise_error(F.concat(F.lit(f"a row of {key} "), F.col(key).cast("string"), F.lit(f" is open since after {as_of}")))
    start = F.when((F.col(START) > day) & F.col("_new").isNotNull(), refused.cast("date")).otherwise(F.col(START))
    known, told = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    gone = known & ~told & F.lit(whole)
    changed = known & told & ~F.col("_old").eqNullSafe(F.col("_new"))
    same_day = F.col(START) == day

    def row(values, since, until):
        return F.struct(F.coalesce(F.col(key), F.col("_key")).alias(key), *[values[a].alias(a) for a in attributes], since.alias(START), until.alias(END))

    nothing = F.lit(None).cast("date")
    before = F.when(known & ~(changed | gone), row(F.col("_old"), start, nothing)).when((changed | gone) & ~same_day, row(F.col("_old"), start, day))
    after = F.when(told & (~known | changed), row(F.col("_new"), day, nothing))
    rows = met.select(F.explode(F.filter(F.array(before, after), lambda r: r.isNotNull())).alias("_row")).select("_row.*")
    return history.where(~open_row).select(*rows.columns).unionByName(rows).select(key, *attributes, START, END)


def as_of_day(history: DataFrame, day: date) -> DataFrame:
    """The rows that hold on a day."""
    on = F.lit(day.isoformat()).cast("date")
    return history.where((F.col(START) <= on) & (F.col(END).isNull() | (F.col(END) > on)))
