"""Versions, pointers, and moves that fail."""

from datetime import date

import pytest
from conftest import rows

from lakeloom.operators.quality import QualityError, in_one_scan, rows_between, rows_there
from lakeloom.session import scratch_path
from lakeloom.sinks import publish
from lakeloom.sinks.files import write_parquet, write_partitioned
from lakeloom.sinks.folders import apply_upsert, finish_replacement
from lakeloom.sinks.storage import Folders
from lakeloom.sources.tables import inline_rows
from lakeloom.streaming.incremental import add_batch, compact_days, fact_rows


def release_of(spark, root, n, checks=(rows_there(),), keep=2):
    def build(release):
        write_parquet(spark.range(n), release.table("t"))
        return {"t": spark.read.parquet(release.table("t"))}

    return publish.publish_checked(spark, root, build, lambda tables: in_one_scan(tables["t"], "t", checks), keep)


def count(spark, root):
    return publish.read_published(spark, root, {"t": spark.range(0).schema})["t"].count()


def test_readers_see_the_last_checked_version(spark):
    root = scratch_path(spark, "published")
    assert publish.published(spark, root) is None
    with pytest.raises(FileNotFoundError):
        count(spark, root)
    with pytest.raises(QualityError):
        release_of(spark, root, 0)
    assert publish.published(spark, root) is None
    for n in (3, 5, 7):
        release_of(spark, root, n)
        assert count(spark, root) == n
    with pytest.raises(QualityError):
        release_of(spark, root, 9, [rows_between(10)])
    assert count(spark, root) == 7
    assert len(Folders(spark, root).folders(f"{root}/versions")) == 2
    with pytest.raises(ValueError):
        release_of(spark, root, 9, keep=0)


def test_two_runs_at_once(spark, monkeypatch):
    """A run that finds its pointer number taken says so and changes nothing."""
    root = scratch_path(spark, "published")
    release_of(spark, root, 3)
    stale = publish._pointers(Folders(spark, root), root)
    release_of(spark, root, 5)
    monkeypatch.setattr(publish, "_pointers", lambda folders, path: stale)
    with pytest.raises(FileExistsError):
        release_of(spark, root, 7)
    monkeypatch.undo()
    assert count(spark, root) == 5


ROWS = "part string, id int, v string"


@pytest.fixture
def refusing(monkeypatch):
    """A file system whose rename answers false for some moves."""
    old = Folders._rename

    def refuse(matching):
        monkeypatch.setattr(Folders, "_rename", lambda self, s, t: False if matching(s, t) else old(self, s, t))

    yield refuse
    monkeypatch.undo()


def test_a_replacement_whose_moves_fail_loses_nothing(spark, refusing, monkeypatch):
    target = scratch_path(spark, "stored")
    first = inline_rows(spark, [("a", 1, "x"), ("b", 2, "x")], ROWS)
    write_partitioned(first, target, ["part"])

    def stored():
        return rows(spark.read.schema(first.schema).parquet(target), "part", "id", "v")

    batch = inline_rows(spark, [("a", 1, "y"), ("b", 3, "y")], ROWS)
    for refused in (lambda s, t: "_old" not in s and t.endswith("part=b"), lambda s, t: "/_old/" in t):
        refusing(refused)
        with pytest.raises(OSError):
            apply_upsert(target, batch, ["part", "id"], "part", update=["v"])
        assert ("b", 2, "x") in stored() and len(stored()) >= 2
        monkeypatch.undo()
    finish_replacement(spark, target)
    apply_upsert(target, batch, ["part", "id"], "part", update=["v"])
    assert stored() == [("a", 1, "y"), ("b", 2, "x"), ("b", 3, "y")]


def test_a_compaction_whose_moves_fail_loses_nothing(spark, refusing, monkeypatch):
    target = scratch_path(spark, "facts")
    schema = inline_rows(spark, [], "id int, time timestamp").schema
    for n in range(2):
        batch = spark.sql(f"SELECT CAST(id AS int) AS id, timestamp '2024-01-01' AS time FROM range({3 * n}, {3 * n + 3})")
        add_batch(batch, target, f"load-{n}", ["id"], "time", ["time"])
    refusing(lambda s, t: "merged-" in t and "_compact" not in t)
    with pytest.raises(OSError):
        compact_days(spark, target, schema, date(2024, 2, 1))
    # The merged rows and the old ones are both at the side; the next run moves one in.
    monkeypatch.undo()
    compact_days(spark, target, schema, date(2024, 2, 1))
    assert rows(fact_rows(spark, target, schema), "id") == [(i,) for i in range(6)]
