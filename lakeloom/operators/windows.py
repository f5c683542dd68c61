"""Running sums and periods between markers, safe for users with very many rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.layout import hot_keys, many_to_one
from lakeloom.session import scratch_path
from lakeloom.sinks.files import write_parquet

# A key with fewer rows than this is small enough for one task; at most so many keys
# are treated as hot (each then holds at least that fraction of all rows).
HOT_ROWS = 1_000_000
HOT_KEYS = 100_000

# monotonically_increasing_id() holds the partition above this bit, the row below it.
_ROW_BITS = 33


def _kept(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Written to the shared folder and read back: later steps see the same rows in the same
    places, whatever executors are lost."""
    path = scratch_path(df.sparkSession, label)
    if by:
        df.write.partitionBy(*by).parquet(path)
    else:
        write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prefix_sums(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over a key's rows up to each row, as column ``name``, by two levels.

    Rows are placed by ranges of (key, order), cut where a sample says that they hold about
    the same number of rows, so a key of any size lies in as many ranges as it needs, rows
    of one moment too. Each range is summed on its own, and what the ranges before hold of
    the key, one row for each range and key, is added.
    """
    by_key = [F.asc_nulls_first(k) for k in keys]
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    order = [*by_key, *order_by, F.asc("_salt")]
    ranged = salted.repartitionByRange(*order).sortWithinPartitions(*order).drop("_salt").withColumn("_at", F.monotonically_increasing_id())
    placed = _kept(ranged, "ranges").withColumn("_part", F.shiftright("_at", _ROW_BITS))
    parts = placed.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    openings = parts.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.col("_part").alias("_o_part"), F.sum("_sum").over(before).alias("_opening"))
    openings = openings.where(F.col("_opening").isNotNull())
    within = Window.partitionBy(*keys, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.withColumn(name, F.sum(value).over(within))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys], F.col("_part") == F.col("_o_part"))
    # Both sides meet by key and range, which no key fills alone.
    opened = summed.join(openings, same, "left")
    return opened.select(*df.columns, F.coalesce(F.col("_opening") + F.col(name), F.col("_opening"), F.col(name)).alias(name))


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: Column,
    name: str,
    frame: str = "rows",
    ties: Sequence[str | Column] = (),
    descending: bool = True,
    hot_rows: int | None = None,
) -> DataFrame:
    """Running sum of ``value`` per key along ``time``, as column ``name``.

    ``value`` is a whole number or decimal. A sum of doubles would depend on whether a key
    is split, so doubles are refused; ``functions.exact.units`` makes whole numbers of them.

    ``frame="range"`` gives rows of equal time the same sum; ``"rows"`` adds them one
    by one in the order of ``ties``.

    A plain window brings all rows of a key into one task. That stays so for ordinary
    keys, and where no key is hot that is all: the input is read once for the counts of
    keys and once for the window. If there are hot keys the second pass writes the rows in
    two parts, and those of hot keys go through ``prefix_sums``. With ``"range"`` the rows of
    one moment are added before that, and each row then takes the sum of its moment, so a
    moment may hold any number of rows too.
    """
    if frame not in ("rows", "range"):
        raise ValueError("frame is 'rows' or 'range'")
    if df.select(value.alias("v")).schema["v"].dataType.typeName() in ("double", "float"):
        raise ValueError("a running sum needs whole numbers or decimals")
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    by_time = (F.desc_nulls_last if descending else F.asc_nulls_first)(time)
    in_order = [by_time, *[F.asc_nulls_first(t) if isinstance(t, str) else t for t in ties]]

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys)
        if frame == "range":
            w = w.orderBy(by_time).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        else:
            w = w.orderBy(*in_order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.select(*df.columns, F.sum("_add").over(w).alias(name))

    valued = df.withColumn("_add", value)
    hot = _kept(hot_keys(df, keys, at_least_rows=hot_rows, at_most_keys=HOT_KEYS).select(*keys), "hot_keys")
    if not hot.limit(1).count():
        return plain(valued)
    marked = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot"))
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    # No more than HOT_KEYS rows, so the broadcast is bounded.
    flagged = valued.join(F.broadcast(marked), same_key, "left").select(*valued.columns, F.coalesce("_hot", F.lit(False)).alias("_hot"))
    halves = _kept(flagged, "by_heat", ["_hot"])
    ordinary, heavy = (halves.where(F.col("_hot") == h).drop("_hot") for h in (False, True))
    if frame == "rows":
        summed = prefix_sums(heavy, keys, in_order, "_add", name).select(*df.columns, name)
    else:
        moments = heavy.groupBy(*keys, time).agg(F.sum("_add").alias("_add"))
        sums = prefix_sums(moments, keys, [by_time], "_add", name)
        # Null keys and times meet too; a hash of both spreads a key over tasks.
        mark = [F.xxhash64(*keys, time).alias("_moment"), *[F.col(c).isNull().alias(f"_null_{c}") for c in (*keys, time)]]
        nulls = [f"_null_{c}" for c in (*keys, time)]
        there = sums.select(*mark, *[F.col(c).alias(f"_m_{c}") for c in (*keys, time)], name)
        equal = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in (*keys, time)])
        summed = many_to_one(heavy.select("*", *mark), there, ["_moment", *nulls]).where(equal).select(*df.columns, name)
    return plain(ordinary).unionByName(summed)


def marker_periods(
    df: DataFrame,
    user: str,
    time: str,
    is_marker: Column,
    frame: str = "range",
    ties: Sequence[str | Column] = (),
    **splitting,
) -> DataFrame:
    """Number each user's periods, counted backwards in time: a period ends at a marker."""
    return running_sum(df, [user], time, is_marker.cast("long"), "period", frame=frame, ties=ties, **splitting)


def mean_between_markers(
    df: DataFrame,
    user: str,
    time: str,
    is_event: Column,
    is_marker: Column,
    frame: str = "range",
    ties: Sequence[str | Column] = (),
    **splitting,
) -> DataFrame:
    """Mean number of events per period, over periods that have any."""
    marked = df.where(is_event | is_marker).withColumn("_event", is_event).withColumn("_marker", is_marker)
    periods = marker_periods(marked, user, time, F.col("_marker"), frame=frame, ties=ties, **splitting)
    per_period = periods.where("_event").groupBy(user, "period").agg(F.count(F.lit(1)).alias("events"))
    return per_period.agg((F.sum("events") / F.count("events")).alias("mean_events"))
