"""Data checks. Each returns rows (table_name, check_name, failing_rows, passed).

Checks that are one aggregate each (rows there, nulls, bounds, newest row, volume) are
values, so any number of them share one scan (``in_one_scan``) or need none of their own:
``Observed`` takes them in the pass that writes the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class QualityError(AssertionError):
    """A check failed."""


def _report(counted: DataFrame, table: str, check: str | Column, failing: Column) -> DataFrame:
    check = F.lit(check) if isinstance(check, str) else check
    return counted.select(
        F.lit(table).alias("table_name"),
        check.alias("check_name"),
        failing.cast("long").alias("failing_rows"),
        (failing == 0).alias("passed"),
    )


def all_of(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


@dataclass(frozen=True)
class Check:
    """An aggregate over a table, and how many rows fail given its value. A check needs no
    session until it is taken."""

    name: str
    measure: Callable[[], Column]
    failing: Callable[[Column], Column]


def rows_there() -> Check:
    return Check("has_rows", lambda: F.count(F.lit(1)), lambda n: F.when(n == 0, 1).otherwise(0))


def null_free(column: str) -> Check:
    return Check(f"not_null:{column}", lambda: F.count(F.when(F.col(column).isNull(), 1)), lambda n: n)


def bounded(column: str, low: float, high: float) -> Check:
    return Check(f"bounds:{column}", lambda: F.count(F.when(~F.col(column).between(low, high), 1)), lambda n: n)


def rows_between(at_least: int, at_most: int | None = None) -> Check:
    def failing(n: Column) -> Column:
        outside = n < at_least if at_most is None else (n < at_least) | (n > at_most)
        return F.when(outside, 1).otherwise(0)

    return Check("volume", lambda: F.count(F.lit(1)), failing)


def newest_from(time: str, not_before: str) -> Check:
    return Check(f"fresh:{time}", lambda: F.max(time), lambda t: F.when(t.isNull() | (t < F.lit(not_before).cast("timestamp_ntz")), 1).otherwise(0))


def _judged(measured: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """A report from one row with the checks' measures, ``_0`` and on."""
    results = [F.struct(F.lit(c.name).alias("check"), c.failing(F.col(f"_{i}")).cast("long").alias("n")) for i, c in enumerate(checks)]
    return _report(measured.select(F.explode(F.array(*results)).alias("r")).select("r.check", "r.n"), table, F.col("check"), F.col("n"))


def in_one_scan(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """The report of any number of checks from one aggregate over the table."""
    return _judged(df.agg(*[c.measure().alias(f"_{i}") for i, c in enumerate(checks)]), table, checks)


class Observed:
    """Checks and the row count of a table, measured while it is written.

    Call it with the frame in the place where rows go to the writer, after any shuffle: the
    tasks there count once, however often others ran again. ``report`` and ``rows`` answer
    when the write is done and read nothing.
    """

    def __init__(self, table: str, checks: Sequence[Check] = ()):
        self.table, self._checks = table, list(checks)
        self._observation = Observation(f"{table}-{uuid.uuid4().hex}")
        self._spark: SparkSession | None = None
        self._schema = None

    def __call__(self, df: DataFrame) -> DataFrame:
        measures = [c.measure().alias(f"_{i}") for i, c in enumerate(self._checks)]
        self._spark, self._schema = df.sparkSession, df.agg(*measures).schema if measures else None
        return df.observe(self._observation, F.count(F.lit(1)).alias("rows"), *measures)

    @property
    def rows(self) -> int:
        return self._observation.get["rows"]

    def report(self) -> DataFrame:
        if self._schema is None:
            raise ValueError(f"no checks of {self.table} were asked for")
        found = self._observation.get
        measured = self._spark.createDataFrame([tuple(found[f"_{i}"] for i in range(len(self._checks)))], self._schema)
        return _judged(measured, self.table, self._checks)


def observed_counts(spark: SparkSession, observed: Sequence[Observed]) -> DataFrame:
    """Row count per table, from the passes that wrote them."""
    return spark.createDataFrame([(o.table, o.rows) for o in observed], "table_name string, row_count bigint")


def has_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A table fails if it is empty (one failing row stands for the missing ones)."""
    return all_of(
        [
            _report(df.agg(F.count(F.lit(1)).alias("n")), name, "has_rows", F.when(F.col("n") == 0, 1).otherwise(0))
            for name, df in tables.items()
        ]
    )


def no_nulls(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Null counts of all columns in one pass, one report row per column."""
    return in_one_scan(df, table, [null_free(c) for c in columns])


def unique_key(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Counts key values that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _report(repeated.agg(F.count(F.lit(1)).alias("n")), table, f"unique:{','.join(keys)}", F.col("n"))


def no_orphans(df: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Counts rows whose key has no parent. Rows are counted per key first, so a hot
    key joins as one row."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_key).alias(key)).distinct()
    lost = per_key.join(parents, key, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return _report(lost, table, f"orphan:{key}", F.col("n"))


def expected_value(spark: SparkSession, table: str, sql: str, expected: int) -> DataFrame:
    """Compares the single value of a query with what it should be; a difference, null
    or missing row counts as one failure. Whole numbers are compared as decimals, so
    none is rounded; a value that is no number differs."""
    value = spark.sql(sql)
    actual = value.select(F.col(f"`{value.columns[0]}`").cast("string").try_cast("decimal(38,10)").alias("v"))
    ok = actual.agg(F.count(F.when(F.col("v") == F.lit(str(expected)).cast("decimal(38,10)"), 1)).alias("ok"))
    return _report(ok, table, "expected_value", F.when(F.col("ok") == 1, 0).otherwise(1))


def volume(df: DataFrame, table: str, at_least: int, at_most: int | None = None) -> DataFrame:
    """Row count within bounds."""
    return in_one_scan(df, table, [rows_between(at_least, at_most)])


def fresh(df: DataFrame, table: str, time: str, not_before: str) -> DataFrame:
    """The newest row is at or after a given time."""
    return in_one_scan(df, table, [newest_from(time, not_before)])


def within_bounds(df: DataFrame, table: str, column: str, low: float, high: float) -> DataFrame:
    """Counts values outside [low, high]."""
    return in_one_scan(df, table, [bounded(column, low, high)])


def load_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    return all_of(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    )


def require(report: DataFrame) -> None:
    """Raise if a check failed. Only failed report rows, one per check, reach the driver."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise QualityError("; ".join(f"{r.table_name} {r.check_name}: {r.failing_rows}" for r in failed))
