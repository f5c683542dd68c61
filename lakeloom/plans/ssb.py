"""Star-schema queries: one dimension, two dimensions, drill-down, co-located join."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.exact import from_units, net_revenue, units
from lakeloom.functions.times import in_month, in_year
from lakeloom.operators.layout import estimated_bytes, replicate
from lakeloom.plans.registry import query
from lakeloom.plans.olap import REV_SCALE, places
from lakeloom.session import scratch_path
from lakeloom.sinks.catalog import drop_tables, write_bucketed
from lakeloom.sinks.files import write_parquet
from lakeloom.sources.tables import Tables


#: Bytes of lines, by Catalyst's estimate, that a bucket is made for.
BUCKET_BYTES = 256 << 20


def discounted() -> Column:
    return units(F.col("l_extendedprice") * F.col("l_discount"), REV_SCALE)


@query("""
    SELECT CAST(SUM(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))) AS DOUBLE) AS revenue
    FROM lineitem, orders
    WHERE l_orderkey = o_orderkey AND year(o_orderdate) = 1997 AND l_discount BETWEEN 0.01 AND 0.03 AND l_quantity < 24""")
def ssb_one_dim(t: Tables) -> DataFrame:
    lines = t.lineitem.where(F.col("l_discount").between(0.01, 0.03) & (F.col("l_quantity") < 24))
    orders = t.orders.where(in_year(F.col("o_orderdate"), 1997)).select("o_orderkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.agg(from_units(F.sum(discounted()), REV_SCALE).alias("revenue"))


@query("""
    SELECT CAST(SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue,
           year(o_orderdate) AS "year", p_brand
    FROM lineitem, orders, part, supplier, nation, region
    WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey AND l_suppkey = s_suppkey
      AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey AND p_type = 'ECONOMY' AND r_name = 'AMERICA'
    GROUP BY year(o_orderdate), p_brand""")
def ssb_two_dim(t: Tables) -> DataFrame:
    here = places(t).where(F.col("r_name") == "AMERICA")
    suppliers = t.supplier.join(here, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey")
    parts = t.part.where(F.col("p_type") == "ECONOMY").select("p_partkey", "p_brand")
    # The two selective dimensions cut the lines before they are shuffled to orders.
    lines = (
        t.lineitem.join(replicate(suppliers, rows_of=t.supplier), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", "p_brand", units(net_revenue(), REV_SCALE).alias("rev"))
    )
    years = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    joined = lines.join(years, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("year", "p_brand").agg(from_units(F.sum("rev"), REV_SCALE).alias("revenue"))


@query("""
    SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, year(o_orderdate) AS "year",
           CAST(SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue
    FROM customer, lineitem, supplier, orders, nation cn, nation sn
    WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND l_suppkey = s_suppkey
      AND c_nationkey = cn.n_nationkey AND s_nationkey = sn.n_nationkey
      AND (cn.n_name = 'NATION_1' OR cn.n_name = 'NATION_2') AND (sn.n_name = 'NATION_1' OR sn.n_name = 'NATION_2')
      AND year(o_orderdate) = 1997 AND month(o_orderdate) = 12
    GROUP BY cn.n_name, sn.n_name, year(o_orderdate)""")
def ssb_drill(t: Tables) -> DataFrame:
    two = (F.col("n_name") == "NATION_1") | (F.col("n_name") == "NATION_2")
    nations = replicate(t.nation.where(two).select("n_nationkey", "n_name"))
    buyers = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("customer_nation")
    )
    suppliers = t.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("supplier_nation")
    )
    orders = (
        t.orders.where(in_month(F.col("o_orderdate"), 1997, 12))
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "customer_nation", F.year("o_orderdate").alias("year"))
    )
    lines = t.lineitem.join(replicate(suppliers, rows_of=t.supplier), F.col("l_suppkey") == F.col("s_suppkey"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        joined.groupBy("customer_nation", "supplier_nation", "year")
        .agg(from_units(F.sum(units(net_revenue(), REV_SCALE)), REV_SCALE).alias("revenue"))
        .orderBy("year", F.desc("revenue"), "customer_nation", "supplier_nation")
    )


_SAME_DIST = """
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS ship_date,
           CAST(SUM(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))) AS DOUBLE) AS revenue
    FROM lineitem, part WHERE l_partkey = p_partkey GROUP BY strftime(l_shipdate, '%Y-%m-%d')"""


def by_ship_date(joined: DataFrame, metric: Column) -> DataFrame:
    summed = joined.groupBy("l_shipdate").agg(from_units(F.sum(metric), REV_SCALE).alias("revenue"))
    return summed.orderBy("l_shipdate").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"), "revenue")


@query(_SAME_DIST)
def ssb_same_dist(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return by_ship_date(joined, discounted())


def part_buckets(t: Tables, buckets: int | None = None, run: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Daily sales per part, and parts, stored in matching buckets.

    Lines are summed to one row per part and day before they are bucketed: a part with
    a third of all lines fills its bucket with no more rows than there are days. There are
    as many buckets as the lines have blocks of ``BUCKET_BYTES``, and one for each core.
    """
    buckets = buckets or max(t.spark.sparkContext.defaultParallelism, estimated_bytes(t.lineitem) // BUCKET_BYTES)
    daily = t.lineitem.groupBy("l_partkey", "l_shipdate").agg(F.sum(discounted()).alias("revenue"))
    run = run or uuid.uuid4().hex
    sales = write_bucketed(
        daily, f"daily_part_sales_{run}", ["l_partkey"], buckets, ["l_partkey", "l_shipdate"], scratch_path(t.spark, "sales")
    )
    parts = write_bucketed(t.part.select("p_partkey"), f"parts_{run}", ["p_partkey"], buckets, None, scratch_path(t.spark, "parts"))
    return sales, parts


def same_dist_join(sales: DataFrame, parts: DataFrame) -> DataFrame:
    return by_ship_date(
        sales.join(parts.hint("merge"), F.col("l_partkey") == F.col("p_partkey")), F.col("revenue")
    )


@query(_SAME_DIST)
def ssb_same_dist_bucketed(t: Tables) -> DataFrame:
    """The answer is kept, so that the tables can be dropped again."""
    run, path = uuid.uuid4().hex, scratch_path(t.spark, "daily_sales")
    write_parquet(same_dist_join(*part_buckets(t, run=run)), path)
    drop_tables(t.spark, [f"daily_part_sales_{run}", f"parts_{run}"])
    return t.spark.read.parquet(path).orderBy("ship_date")
