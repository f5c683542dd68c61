"""Range tables: merges against one build, files that lookups and merges touch."""

import random

import pytest
from conftest import rows

from lakeloom.operators.lookup import QueryTable
from lakeloom.session import scratch_path
from lakeloom.sinks.ranged import RangedTable
from lakeloom.sinks.storage import Folders
from lakeloom.sources.tables import inline_rows

SCHEMA = "user int, item string, n int, v string"


def scans(plan):
    """Leaves of an executed plan, looking into adaptive stages."""
    name = plan.getClass().getSimpleName()
    if name.endswith("QueryStageExec"):
        return scans(plan.plan())
    if name == "AdaptiveSparkPlanExec":
        return scans(plan.executedPlan())
    children = plan.children()
    return [leaf for i in range(children.size()) for leaf in scans(children.apply(i))] or [plan]


def files_read(df):
    """Files that the scan of a query has opened."""
    df.collect()
    return sum(leaf.metrics().apply("numFiles").value() for leaf in scans(df._jdf.queryExecution().executedPlan()) if leaf.metrics().contains("numFiles"))


def files_of(spark, path):
    folders = Folders(spark, path)
    return {name: sorted(r.path for r in spark.read.format("binaryFile").load(p).select("path").collect()) for name, p in folders.folders(path).items() if "=" in name}


def test_merges_equal_one_build(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, 1, 1, *range(40)]), rng.choice([None, "a", "b", "c"]), i, f"v{i}") for i in range(600)]
    path = scratch_path(spark, "ranged")
    table = RangedTable.create(inline_rows(spark, data[:200], SCHEMA), path, ["user"], ["item"], ["n"], ranges=7)
    for batch in (data[200:420], data[420:], data[420:], data[:50]):
        table.merge(inline_rows(spark, batch, SCHEMA))
    want = QueryTable.build(inline_rows(spark, data, SCHEMA), ["user"], ["item"], ["n"]).rows
    assert rows(table.rows(spark)) == rows(want)
    for user in (1, 5, 39):
        assert rows(table.where(spark, user=user)) == rows(want.where(f"user = {user}"))
    assert rows(table.where(spark, user=1, item="b")) == rows(want.where("user = 1 and item = 'b'"))
    with pytest.raises(ValueError):
        table.where(spark, item="b")


def test_lookups_and_merges_touch_few_files(spark):
    path = scratch_path(spark, "ranged")
    frame = spark.sql("SELECT CAST(id AS int) AS user, 'a' AS item, 0 AS n, 'old' AS v FROM range(1000)")
    table = RangedTable.create(frame, path, ["user"], ["item"], ["n"], ranges=10)
    before = files_of(spark, path)
    assert len(before) == 10
    found = table.where(spark, user=555)
    assert files_read(found) == 1 and rows(found) == [(555, "a", 0, "old")]
    assert rows(table.where(spark, user=-5)) == [] and rows(table.where(spark, user=5000)) == []
    touched = table.merge(inline_rows(spark, [(554, "a", 1, "new"), (555, "b", 1, "new")], SCHEMA))
    after = files_of(spark, path)
    changed = {name for name in before if before[name] != after[name]}
    assert len(touched) == 1 and changed == {f"key_range={touched[0]}"}
    assert rows(table.where(spark, user=555), "item", "v") == [("a", "old"), ("b", "new")]
    assert table.merge(inline_rows(spark, [], SCHEMA)) == []
    assert table.rows(spark).count() == 1001


def test_a_large_partition_key_spans_ranges(spark):
    frame = spark.sql("SELECT 1 AS user, lpad(CAST(id AS string), 4, '0') AS item, 0 AS n, 'x' AS v FROM range(1000)")
    table = RangedTable.create(frame, scratch_path(spark, "ranged"), ["user"], ["item"], ["n"], ranges=5)
    assert table.where(spark, user=1).count() == 1000
    assert files_read(table.where(spark, user=1, item="0500")) <= 2
    empty = RangedTable.create(frame.limit(0), scratch_path(spark, "ranged"), ["user"], ["item"], ["n"])
    empty.merge(frame.limit(3))
    assert empty.rows(spark).count() == 3
