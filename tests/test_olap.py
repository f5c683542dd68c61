import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from lakeloom.functions.exact import units
from lakeloom.operators.layout import estimated_bytes, hot_keys, many_to_one, replicate
from lakeloom.operators.olap import Cube
from lakeloom.plans import olap, ssb
from lakeloom.session import scratch_path
from lakeloom.sources.tables import inline_rows

SALES = [
    (1, "Canada", "Lethbridge", "PG", 10.25), (1, "Canada", "Woodridge", "G", 5.5), (2, "Australia", "Perth", "PG", 7.0),
    (2, "Canada", "Lethbridge", "R", 3.25), (2, "Australia", "Sydney", "G", 2.0),
]


@pytest.fixture(scope="module")
def cube(spark):
    facts = inline_rows(spark, SALES, "month int, country string, city string, rating string, amount double")
    return Cube(facts, F.col("amount"), "revenue", ("month", "country"), {"place": ("country", "city")})


def test_slice_and_dice(cube):
    assert rows(cube.slice("country", "Canada").totals()) == [(1, 15.75), (2, 3.25)]
    assert rows(cube.dice({"country": ["Canada"], "month": [1]}).totals()) == [(1, "Canada", 15.75)]


def test_levels(cube):
    finer = cube.drill_down("country")
    assert finer.dimensions == ("month", "country", "city")
    assert rows(finer.totals())[0] == (1, "Canada", "Lethbridge", 10.25)
    by_city = Cube(cube.facts, cube.metric, "revenue", ("month", "city"), cube.hierarchies)
    assert rows(by_city.roll_up("city").totals()) == rows(cube.totals())
    with pytest.raises(ValueError):
        cube.roll_up("country")
    with pytest.raises(ValueError):
        cube.drill_down("month")


def test_top(cube):
    assert [r.revenue for r in cube.top(2).collect()] == [15.75, 9.0]


def test_cube_and_grouping_sets_agree(cube):
    sets = cube.grouping_sets([[], ["month"], ["country"], ["month", "country"]])
    whole = rows(cube.cube(), "month", "country", "revenue", "grouping_id")
    assert rows(sets, "month", "country", "revenue", "grouping_id") == whole
    assert (None, None, 28.0, 3) in whole
    assert len(cube.rollup().collect()) == len([r for r in whole if r[3] != 2])


def test_stored_cube(spark, cube):
    stored = cube.materialize(scratch_path(spark, "test_cube"))
    assert rows(stored.totals("country")) == [("Australia", 9.0), ("Canada", 19.0)]
    assert rows(stored.totals()) == [(28.0,)]
    assert rows(stored.totals("month", "country")) == rows(cube.totals())
    assert "PartitionFilters: [isnotnull(grouping_id" in plan_text(stored.totals("country"))


def test_cube_expands_after_aggregation(tables):
    plan = plan_text(olap.supplier_cube(tables).cube())
    below_expand = plan[plan.index("Expand") :]
    assert "HashAggregate" in below_expand


def test_bucketed_join_has_no_shuffle_below_it(tables):
    joined = ssb.same_dist_join(*ssb.part_buckets(tables))
    plan = plan_text(joined)
    below = plan[plan.index("SortMergeJoin") :]
    assert "Exchange" not in below and "Bucketed: true" in below


def test_replicate_keeps_to_its_bound(spark, tables):
    dim = tables.supplier
    size = estimated_bytes(dim)
    marked = tables.lineitem.join(replicate(dim, size), F.col("l_suppkey") == F.col("s_suppkey"))
    assert "ResolvedHint" in marked._jdf.queryExecution().analyzed().toString()
    plain = tables.lineitem.join(replicate(dim, size - 1), F.col("l_suppkey") == F.col("s_suppkey"))
    assert "ResolvedHint" not in plain._jdf.queryExecution().analyzed().toString()


def skewed(spark):
    """A third of the rows has key -1; two rows have no key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") < 3, F.lit(None)).otherwise(F.col("id"))
    return spark.range(0, 30000, 1, 8).select("id", key.alias("k"), F.repeat(F.lit("x"), 50).alias("pad"))


def test_hot_keys(spark):
    df = skewed(spark)
    assert rows(hot_keys(df, ["k"], 100), "k", "n_rows") == [(-1, 10000)]
    assert hot_keys(df, ["k"], 10001).count() == 0


def test_many_to_one_needs_equal_types(spark):
    facts = inline_rows(spark, [(1, 0.0), (2, -0.0), (None, 1.0)], "k int, d double")
    with pytest.raises(ValueError):
        many_to_one(facts, inline_rows(spark, [(1, "a")], "k bigint, v string"), ["k"])
    zero = inline_rows(spark, [(0.0, "zero")], "d double, v string")
    assert rows(many_to_one(facts, zero, ["d"]), "k", "v") == [(1, "zero"), (2, "zero"), (None, None)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_is_split_in_join_to_grouped_reference(spark, how):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = skewed(spark)
        reference = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = many_to_one(facts, reference, ["k"], how)
        got = joined.collect()
        assert "skew=true" in plan_text(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == (30000 if how == "left" else 29998)
    assert sum(r.n for r in got if r.k == -1) == 10000 * 10000
    assert {r.n for r in got if r.k != -1} == ({1, None} if how == "left" else {1})


# Monthly revenue of two countries with the totals to expect (fixed values).
MONTHS = [
    (1, "Australia", 2364.19), (1, "Canada", 2460.24), (2, "Australia", 4895.10), (2, "Canada", 4736.78),
    (3, "Australia", 12060.33), (3, "Canada", 11826.23), (4, "Australia", 14136.07), (4, "Canada", 14423.39),
    (5, "Australia", 271.08), (5, "Canada", 243.10),
]
TOTALS = {
    (1, None): 4824.43, (2, None): 9631.88, (3, None): 23886.56, (4, None): 28559.46, (5, None): 514.18,
    (None, None): 67416.51, (None, "Australia"): 33726.77, (None, "Canada"): 33689.74,
}


def test_known_totals(spark):
    facts = inline_rows(spark, MONTHS, "month int, country string, amount double").withColumn("cents", units("amount", 2))
    cube = Cube(facts, F.col("cents"), "revenue", ("month", "country"), scale=2)
    want = {**TOTALS, **{(m, c): v for m, c, v in MONTHS}}
    for grouped in (cube.cube(), cube.grouping_sets([[], ["month"], ["country"], ["month", "country"]])):
        assert {(r.month, r.country): r.revenue for r in grouped.collect()} == want
