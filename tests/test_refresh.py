"""Cubes refreshed by deltas against cubes built anew."""

import random

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from lakeloom.operators.refresh import RefreshedCube
from lakeloom.session import scratch_path
from lakeloom.sinks.publish import published
from lakeloom.sources.tables import inline_rows

SCHEMA = "a string, b int, part int, cents bigint"


def cube(spark, **options):
    return RefreshedCube(scratch_path(spark, "cube"), ("a", "b"), F.col("cents"), "part", 2, **options)


def data(n, seed):
    rng = random.Random(seed)
    return [(rng.choice([None, "x", "y"]), rng.choice([None, 1, 2, 3]), rng.randrange(500), rng.randrange(-1000, 1000)) for _ in range(n)]


def test_deltas_equal_one_build(spark):
    parts = [data(700, 1), data(1, 2), data(900, 3), []]
    refreshed, whole = cube(spark), cube(spark)
    for n, part in enumerate(parts):
        assert refreshed.refresh(inline_rows(spark, part, SCHEMA), f"d{n}")
        assert not refreshed.refresh(inline_rows(spark, part, SCHEMA), f"d{n}")
    everything = [r for part in parts for r in part]
    whole.refresh(inline_rows(spark, everything, SCHEMA), "all")
    exact = ["grouping_id", "a", "b", "total", "n_facts"]
    assert rows(refreshed.all_totals(spark), *exact) == rows(whole.all_totals(spark), *exact)
    by_a = {r.a: r for r in refreshed.totals(spark, "a").collect()}
    for a in (None, "x", "y"):
        mine = [r for r in everything if r[0] == a]
        distinct = len({r[2] for r in mine})
        assert by_a[a].n_facts == len(mine) and by_a[a].total == pytest.approx(sum(r[3] for r in mine) / 100)
        # Five standard errors.
        assert abs(by_a[a].n_distinct - distinct) <= 0.08 * distinct
    assert refreshed.totals(spark).first().n_facts == len(everything)


def test_one_grouping_reads_one_folder(spark):
    some = cube(spark, sets=((), ("a", "b")))
    some.refresh(inline_rows(spark, data(50, 4), SCHEMA), "d")
    assert some.totals(spark, "a").count() == 0 and some.totals(spark).count() == 1
    plan = plan_text(some.totals(spark, "a", "b"))
    assert "PartitionFilters: [isnotnull(grouping_id" in plan


def test_a_broken_refresh_leaves_the_cube(spark):
    kept = cube(spark)
    kept.refresh(inline_rows(spark, data(20, 5), SCHEMA), "d1")
    before = published(spark, kept.path)
    broken = inline_rows(spark, data(20, 6), SCHEMA).withColumn("cents", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        kept.refresh(broken, "d2")
    assert published(spark, kept.path) == before and kept.totals(spark).first().n_facts == 20
    with pytest.raises(FileNotFoundError):
        cube(spark).all_totals(spark)
