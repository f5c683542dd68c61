"""Revenue cubes: day, part type and customer place; month and supplier region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.exact import net_revenue, units
from lakeloom.operators.layout import replicate
from lakeloom.operators.olap import Cube
from lakeloom.operators.refresh import RefreshedCube
from lakeloom.plans.registry import query
from lakeloom.session import scratch_path
from lakeloom.sources.tables import Tables

# The largest groups a report shows.
REPORT_ROWS = 20
# Price has two digits after the point and discount two: their product has four.
REV_SCALE = 4
PLACES = ("r_name", "n_name", "c_mktsegment")


def places(t: Tables) -> DataFrame:
    """Nations with their region, joined before they meet anything large."""
    joined = t.nation.join(replicate(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return replicate(joined.select("n_nationkey", "n_name", "r_name"), rows_of=t.nation)


def sales_cube(t: Tables) -> Cube:
    """Lines with part type, order day and customer place.

    Orders meet customers and lines meet parts before the two sides join on the order
    key, so lines are shuffled at most twice.
    """
    orders = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(places(t), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", F.dayofmonth("o_orderdate").alias("day"), *PLACES)
    )
    lines = t.lineitem.join(replicate(t.part.select("p_partkey", "p_type")), F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "p_type", units(net_revenue(), REV_SCALE).alias("rev")
    )
    facts = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return Cube(facts, F.col("rev"), "revenue", ("day", "p_type", "n_name"), {"place": PLACES}, REV_SCALE)


def supplier_cube(t: Tables) -> Cube:
    """Lines by order month and supplier region."""
    suppliers = t.supplier.join(places(t), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "r_name")
    lines = t.lineitem.join(replicate(suppliers, rows_of=t.supplier), F.col("l_suppkey") == F.col("s_suppkey")).select(
        "l_orderkey", "r_name", units(net_revenue(), REV_SCALE).alias("rev")
    )
    months = t.orders.select("o_orderkey", F.month("o_orderdate").alias("month"))
    facts = lines.join(months, F.col("l_orderkey") == F.col("o_orderkey"))
    return Cube(facts, F.col("rev"), "revenue", ("month", "r_name"), scale=REV_SCALE)


_REV = "CAST(SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue"
_SALES = """
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey"""
_SUPPLY = """
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _report_sql(dimensions: list[str], where: str = "") -> str:
    shown = {"day": 'day(o_orderdate) AS "day"'}
    keys = {"day": "day(o_orderdate)"}
    select = ", ".join(shown.get(d, d) for d in dimensions)
    group = ", ".join(keys.get(d, d) for d in dimensions)
    return f"""
    SELECT {select}, {_REV} {_SALES} {where}
    GROUP BY {group} ORDER BY revenue DESC, {group} LIMIT {REPORT_ROWS}"""


@query(_report_sql(["day", "p_type", "n_name"]))
def olap_cube_base(t: Tables) -> DataFrame:
    return sales_cube(t).top(REPORT_ROWS)


@query(_report_sql(["day", "n_name"], "WHERE p_type = 'ECONOMY'"))
def olap_slice(t: Tables) -> DataFrame:
    return sales_cube(t).slice("p_type", "ECONOMY").top(REPORT_ROWS)


@query(
    _report_sql(
        ["day", "p_type", "n_name"],
        "WHERE p_type IN ('ECONOMY', 'SMALL') AND n_name IN ('NATION_1', 'NATION_7', 'NATION_12') AND day(o_orderdate) IN (1, 15, 30)",
    )
)
def olap_dice(t: Tables) -> DataFrame:
    allowed = {"p_type": ["ECONOMY", "SMALL"], "n_name": ["NATION_1", "NATION_7", "NATION_12"], "day": [1, 15, 30]}
    return sales_cube(t).dice(allowed).top(REPORT_ROWS)


@query(_report_sql(["day", "p_type", "r_name"]))
def olap_rollup(t: Tables) -> DataFrame:
    return sales_cube(t).roll_up("n_name").top(REPORT_ROWS)


@query(_report_sql(["day", "p_type", "n_name", "c_mktsegment"]))
def olap_drilldown(t: Tables) -> DataFrame:
    return sales_cube(t).drill_down("n_name").top(REPORT_ROWS)


def _grouping_sql(group_by: str) -> str:
    return f"""
    SELECT "month", r_name, CAST(SUM(rev) AS DOUBLE) AS revenue, GROUPING("month", r_name) AS grouping_id
    FROM (SELECT month(o_orderdate) AS "month", r_name,
                 CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS rev {_SUPPLY})
    GROUP BY {group_by}"""


@query(_grouping_sql('GROUPING SETS ((), ("month"), (r_name), ("month", r_name))'))
def olap_grouping_sets(t: Tables) -> DataFrame:
    return supplier_cube(t).grouping_sets([[], ["month"], ["r_name"], ["month", "r_name"]])


@query(_grouping_sql('CUBE ("month", r_name)'))
def olap_cube(t: Tables) -> DataFrame:
    return supplier_cube(t).cube()


@query(_grouping_sql('ROLLUP ("month", r_name)'))
def olap_rollup_keyword(t: Tables) -> DataFrame:
    return supplier_cube(t).rollup()


@query(f'SELECT month(o_orderdate) AS "month", {_REV} {_SUPPLY} GROUP BY month(o_orderdate)')
def olap_from_cube(t: Tables) -> DataFrame:
    stored = supplier_cube(t).materialize(scratch_path(t.spark, "cube"))
    return stored.totals("month")


@query(f"""
    SELECT "month", r_name, CAST(SUM(rev) AS DOUBLE) AS total, COUNT(*) AS n_facts, GROUPING("month", r_name) AS grouping_id
    FROM (SELECT month(o_orderdate) AS "month", r_name,
                 CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS rev {_SUPPLY})
    GROUP BY CUBE ("month", r_name)""")
def olap_cube_refreshed(t: Tables) -> DataFrame:
    """The cube in three deltas by order, the last of which comes twice. The sketches of
    distinct orders are stored too; an estimate has no exact counterpart to compare."""
    facts = supplier_cube(t).facts
    cube = RefreshedCube(scratch_path(t.spark, "refreshed"), ("month", "r_name"), F.col("rev"), "l_orderkey", REV_SCALE)
    for n in (0, 1, 2, 2):
        cube.refresh(facts.where(F.col("l_orderkey") % 3 == n), f"delta-{n}")
    return cube.all_totals(t.spark).drop("n_distinct")
