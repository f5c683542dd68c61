import uuid

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from lakeloom.operators import quality
from lakeloom.plans.catalog import REGISTRY
from lakeloom.session import scratch_path
from lakeloom.sinks.files import write_partitioned
from lakeloom.sources.tables import as_view, inline_rows


@pytest.fixture(scope="module")
def facts(spark):
    return inline_rows(spark, [(1, 10, "2024-01-05"), (2, 10, None), (2, 99, "2024-01-01"), (3, None, None)], "id int, ref int, day string")


def verdict(report):
    return rows(report, "check_name", "failing_rows", "passed")


def test_checks(spark, facts):
    parents = inline_rows(spark, [(10,)], "key int")
    assert verdict(quality.has_rows({"facts": facts})) == [("has_rows", 0, True)]
    assert verdict(quality.has_rows({"none": facts.where("id > 9")})) == [("has_rows", 1, False)]
    assert verdict(quality.no_nulls(facts, "f", ["id", "day"])) == [("not_null:day", 2, False), ("not_null:id", 0, True)]
    assert verdict(quality.unique_key(facts, "f", ["id"])) == [("unique:id", 1, False)]
    assert verdict(quality.no_orphans(facts, "f", "ref", parents, "key")) == [("orphan:ref", 1, False)]
    assert verdict(quality.volume(facts, "f", 4, 4)) == [("volume", 0, True)]
    assert verdict(quality.volume(facts, "f", 5)) == [("volume", 1, False)]
    assert verdict(quality.fresh(facts, "f", "day", "2024-01-05")) == [("fresh:day", 0, True)]
    assert verdict(quality.fresh(facts.where("id = 3"), "f", "day", "2024-01-05")) == [("fresh:day", 1, False)]
    assert verdict(quality.within_bounds(facts, "f", "ref", 0, 50)) == [("bounds:ref", 1, False)]


def test_expected_value(spark, facts):
    as_view(facts, "checked_facts")
    count = "SELECT count(*) FROM checked_facts WHERE ref IS NULL"
    assert verdict(quality.expected_value(spark, "f", count, 1)) == [("expected_value", 0, True)]
    assert verdict(quality.expected_value(spark, "f", count, 0)) == [("expected_value", 1, False)]
    assert verdict(quality.expected_value(spark, "f", "SELECT max(ref) FROM checked_facts WHERE ref < 0", 0)) == [("expected_value", 1, False)]


def test_require(facts):
    quality.require(quality.has_rows({"facts": facts}))
    with pytest.raises(quality.QualityError, match="not_null:day"):
        quality.require(quality.no_nulls(facts, "facts", ["id", "day"]))


def test_load_report(facts):
    assert rows(quality.load_report({"a": facts, "b": facts.where("id = 2")})) == [("a", 4), ("b", 2)]


CHECKS = [
    quality.rows_there(), quality.rows_between(2, 3), quality.null_free("a"), quality.bounded("a", 0, 5),
    quality.newest_from("t", "2024-01-02 00:00:00"), quality.newest_from("t", "2025-01-01 00:00:00"),
]


def _timed(spark, *data):
    return inline_rows(spark, data, "a int, t string").withColumn("t", F.col("t").cast("timestamp"))


@pytest.mark.parametrize("data", [[(1, "2024-01-01"), (None, "2024-01-03"), (9, None)], [], [(1, "2024-01-01")] * 5])
def test_checks_in_the_pass_that_writes(spark, data):
    """The same report from a scan and from the write, which is one job and reads once."""
    df = _timed(spark, *data)
    observed = quality.Observed("t", CHECKS)
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    write_partitioned(df, scratch_path(spark, "observed"), ["a"], watch=observed)
    report, n = observed.report(), observed.rows
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(report) == rows(quality.in_one_scan(df, "t", CHECKS)) and n == len(data)
    # With adaptive execution the shuffle and the write are jobs of their own; no other ran.
    assert len(jobs) <= 2


def test_one_scan_for_all_checks_of_a_table(spark, tables):
    checks = [quality.rows_there(), quality.null_free("user_id"), quality.newest_from("ts", "2024-01-01 00:00:00")]
    plan = plan_text(quality.in_one_scan(tables.events, "events", checks))
    assert plan.count("FileScan") == 1
    assert REGISTRY["dq_freshness"](spark, tables.root)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_expected_value_is_not_rounded(spark):
    big = 2**60 + 1
    assert quality.expected_value(spark, "t", f"SELECT {big}L", big).first().passed
    assert not quality.expected_value(spark, "t", f"SELECT {big}L", big - 1).first().passed
    for sql in ("SELECT 'x'", "SELECT NULL", "SELECT 1 WHERE false"):
        assert not quality.expected_value(spark, "t", sql, 0).first().passed
