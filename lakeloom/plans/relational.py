"""Projections, filters, joins, aggregates, sorts and set operations.

Dates and times leave these queries as text, and exact decimal sums as doubles, so
that any engine's result can be compared with them value by value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.exact import amount, mean, net_revenue, total
from lakeloom.functions.text import text_key
from lakeloom.functions.times import in_year, is_weekend
from lakeloom.operators.dedup import one_per_key
from lakeloom.operators.layout import keys_of, many_to_one, replicate
from lakeloom.operators.lookup import QueryTable, first_match
from lakeloom.operators.quality import load_report as count_rows
from lakeloom.plans.registry import query
from lakeloom.sources.tables import Tables, as_view

# ---- projections -----------------------------------------------------------------


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_view(t: Tables) -> DataFrame:
    return as_view(t.nation, "lakeloom_nation").select("*")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def proj_columns(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", "c_mktsegment")


@query("""
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS DOUBLE) AS disc_price,
           l_quantity / 1000 AS quantity_k
    FROM lineitem""")
def proj_derived(t: Tables) -> DataFrame:
    priced = t.lineitem.withColumn("disc_price", amount(net_revenue(), 4).cast("double"))
    return priced.withColumn("quantity_k", F.col("l_quantity") / 1000).select(
        "l_orderkey", "l_linenumber", "disc_price", "quantity_k"
    )


@query("""
    SELECT l_orderkey AS "orderkey", l_partkey AS "partkey", l_suppkey AS "suppkey",
           l_returnflag AS "returnflag", l_quantity AS "quantity" FROM lineitem""")
def selectexpr_list(t: Tables) -> DataFrame:
    fields = ["orderkey", "partkey", "suppkey", "returnflag", "quantity"]
    return t.lineitem.selectExpr(*[f"l_{f} AS {f}" for f in fields])


@query("""
    SELECT o_orderkey, CASE WHEN isodow(o_orderdate) IN (6, 7) THEN true ELSE false END AS is_weekend,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high' ELSE 'normal' END AS urgency
    FROM orders""")
def case_flag(t: Tables) -> DataFrame:
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return t.orders.select(
        "o_orderkey",
        F.when(is_weekend(F.col("o_orderdate")), True).otherwise(False).alias("is_weekend"),
        F.when(urgent, "high").otherwise("normal").alias("urgency"),
    )


@query("""
    SELECT c_custkey, TRY_CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS INTEGER) AS name_number,
           TRY_CAST(c_mktsegment AS INTEGER) AS segment_number
    FROM customer""")
def try_cast_int(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        F.regexp_extract("c_name", "([0-9]+)$", 1).try_cast("int").alias("name_number"),
        F.col("c_mktsegment").try_cast("int").alias("segment_number"),
    )


# ---- filters ---------------------------------------------------------------------


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def filter_eq(t: Tables) -> DataFrame:
    return t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@query("""
    SELECT o_orderkey, l_linenumber, l_quantity
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_orderkey IS NOT NULL""")
def filter_not_null(t: Tables) -> DataFrame:
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.where(F.col("l_orderkey").isNotNull()).select("o_orderkey", "l_linenumber", "l_quantity")


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice
    FROM lineitem WHERE l_quantity < 24 AND l_extendedprice > 30000""")
def filter_range(t: Tables) -> DataFrame:
    chosen = t.lineitem.where((F.col("l_quantity") < 24) & (F.col("l_extendedprice") > 30000))
    return chosen.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("""
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n_lines
    FROM lineitem
    WHERE l_discount BETWEEN 0.02 AND 0.04 AND l_returnflag IN ('A', 'R') AND (l_linestatus = 'O' OR l_quantity > 45)
    GROUP BY l_returnflag, l_linestatus""")
def filter_combined(t: Tables) -> DataFrame:
    chosen = t.lineitem.where(
        F.col("l_discount").between(0.02, 0.04)
        & F.col("l_returnflag").isin("A", "R")
        & ((F.col("l_linestatus") == "O") | (F.col("l_quantity") > 45))
    )
    return chosen.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n_lines"))


@query("""
    SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS order_date
    FROM orders WHERE extract(year FROM o_orderdate) = 1997""")
def filter_year(t: Tables) -> DataFrame:
    return t.orders.where(in_year(F.col("o_orderdate"), 1997)).select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date")
    )


@query("""
    SELECT user_id, event_type, COUNT(*) AS n_events FROM events
    GROUP BY user_id, event_type HAVING event_type = 'click' AND COUNT(*) > 1""")
def having_filter(t: Tables) -> DataFrame:
    counted = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n_events"))
    return counted.where((F.col("event_type") == "click") & (F.col("n_events") > 1))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
    FROM lineitem WHERE l_orderkey = 338 AND l_linenumber = 5""")
def point_lookup(t: Tables) -> DataFrame:
    lines = QueryTable(t.lineitem, ("l_orderkey",), ("l_linenumber",))
    return lines.where(l_orderkey=338, l_linenumber=5).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 338")
def prefix_lookup(t: Tables) -> DataFrame:
    lines = QueryTable(t.lineitem, ("l_orderkey",), ("l_linenumber",))
    return lines.where(l_orderkey=338).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


# ---- joins -----------------------------------------------------------------------


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice, c_name
    FROM (lineitem JOIN orders ON l_orderkey = o_orderkey) JOIN customer ON o_custkey = c_custkey""")
def join_3way(t: Tables) -> DataFrame:
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")
    joined = t.lineitem.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", "c_name")


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice, c_name, n_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey""")
def join_4way(t: Tables) -> DataFrame:
    buyers = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(replicate(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "c_name", "n_name")
    )
    joined = t.lineitem.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", "c_name", "n_name")


@query("""
    SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey, l.l_quantity, r.was_returned
    FROM lineitem l LEFT JOIN (
        SELECT DISTINCT l_suppkey, l_partkey, l_quantity, true AS was_returned FROM lineitem WHERE l_returnflag = 'R') r
      ON l.l_suppkey = r.l_suppkey AND l.l_partkey = r.l_partkey AND l.l_quantity = r.l_quantity""")
def join_left_multikey(t: Tables) -> DataFrame:
    on = ["l_suppkey", "l_partkey", "l_quantity"]
    returned = keys_of(t.lineitem.where(F.col("l_returnflag") == "R"), *on).withColumn("was_returned", F.lit(True))
    return many_to_one(t.lineitem, returned, on).select("l_orderkey", "l_linenumber", *on, "was_returned")


@query("""
    SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, COUNT(*) AS n_lines
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    GROUP BY cn.n_name, sn.n_name""")
def join_role_playing(t: Tables) -> DataFrame:
    nation = replicate(t.nation)
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    joined = t.lineitem.join(replicate(t.supplier), F.col("l_suppkey") == F.col("s_suppkey")).join(
        buyers, F.col("l_orderkey") == F.col("o_orderkey")
    )
    # Nation names enter after the counting: 625 pairs instead of every line.
    pairs = joined.groupBy("c_nationkey", "s_nationkey").agg(F.count(F.lit(1)).alias("n_lines"))
    return (
        pairs.join(nation.alias("cn"), F.col("c_nationkey") == F.col("cn.n_nationkey"))
        .join(nation.alias("sn"), F.col("s_nationkey") == F.col("sn.n_nationkey"), "left")
        .groupBy(F.col("cn.n_name").alias("customer_nation"), F.col("sn.n_name").alias("supplier_nation"))
        .agg(F.sum("n_lines").alias("n_lines"))
    )


@query("""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def join_anti(t: Tables) -> DataFrame:
    lines = keys_of(t.lineitem, "l_orderkey")
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_custkey")


@query("""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def join_semi(t: Tables) -> DataFrame:
    returned = keys_of(t.lineitem.where(F.col("l_returnflag") == "R"), "l_orderkey")
    return t.orders.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey", "o_custkey")


@query("""
    SELECT p_partkey, l_suppkey AS cheapest_supplier, l_extendedprice AS lowest_price
    FROM part LEFT JOIN (
        SELECT l_partkey, l_suppkey, l_extendedprice,
               ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice, l_suppkey) AS rn
        FROM lineitem) f ON p_partkey = l_partkey AND rn = 1""")
def lookup_first_match(t: Tables) -> DataFrame:
    offers = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_suppkey", "l_extendedprice")
    found = first_match(
        t.part.select("p_partkey"),
        offers,
        on=["p_partkey"],
        take=["l_suppkey", "l_extendedprice"],
        order_by=["l_extendedprice", "l_suppkey"],
    )
    return found.select(
        "p_partkey", F.col("l_suppkey").alias("cheapest_supplier"), F.col("l_extendedprice").alias("lowest_price")
    )


@query("""
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, s.n_pair_lines
    FROM lineitem l JOIN (
        SELECT l_partkey, l_suppkey, COUNT(*) AS n_pair_lines FROM lineitem GROUP BY l_partkey, l_suppkey) s
      ON l.l_partkey = s.l_partkey AND l.l_suppkey = s.l_suppkey""")
def join_two_keys(t: Tables) -> DataFrame:
    on = ["l_partkey", "l_suppkey"]
    stats = t.lineitem.groupBy(*on).agg(F.count(F.lit(1)).alias("n_pair_lines"))
    return many_to_one(t.lineitem, stats, on, "inner").select("l_orderkey", "l_linenumber", *on, "n_pair_lines")


@query("""
    SELECT p.p_partkey, p.p_brand, CAST(q.rounded_price AS BIGINT) AS rounded_price, q.first_part, q.n_parts
    FROM part p JOIN (
        SELECT p_brand, CAST(p_retailprice AS DECIMAL(18,0)) AS rounded_price,
               MIN(p_partkey) AS first_part, COUNT(*) AS n_parts
        FROM part GROUP BY p_brand, CAST(p_retailprice AS DECIMAL(18,0))) q
      ON p.p_brand = q.p_brand AND CAST(p.p_retailprice AS DECIMAL(18,0)) = q.rounded_price""")
def join_rounded(t: Tables) -> DataFrame:
    # The right side has one row per key, so a part meets one row and not every
    # other part of its price.
    part = t.part.select("p_partkey", "p_brand", amount("p_retailprice", 0).alias("rounded_price"))
    prices = part.groupBy("p_brand", "rounded_price").agg(
        F.min("p_partkey").alias("first_part"), F.count(F.lit(1)).alias("n_parts")
    )
    return many_to_one(part, prices, ["p_brand", "rounded_price"], "inner").select(
        "p_partkey", "p_brand", F.col("rounded_price").cast("bigint"), "first_part", "n_parts"
    )


@query("""
    SELECT o_orderkey, d.c_name, d.n_name FROM orders JOIN (
        SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) d
      ON o_custkey = d.c_custkey""")
def join_derived(t: Tables) -> DataFrame:
    homes = t.customer.join(replicate(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    homes = homes.select("c_custkey", "c_name", "n_name")
    return t.orders.join(homes, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "n_name")


@query("""
    SELECT s_name, COUNT(*) AS n_lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name""")
def join_broadcast(t: Tables) -> DataFrame:
    joined = t.lineitem.join(replicate(t.supplier), F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy("s_name").agg(F.count(F.lit(1)).alias("n_lines"), total("l_extendedprice", 2).alias("gross"))


# ---- aggregates ------------------------------------------------------------------


@query("SELECT COUNT(*) AS n_rows FROM lineitem")
def agg_count(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT event_type, COUNT(*) AS n_events FROM events GROUP BY event_type")
def agg_count_by(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").count().withColumnRenamed("count", "n_events")


@query("""
    SELECT o_orderpriority, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
    FROM orders GROUP BY o_orderpriority""")
def agg_sum_by(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(total("o_totalprice", 2).alias("spent"))


@query("""
    SELECT l_partkey, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_quantity) AS mean_quantity
    FROM lineitem WHERE extract(year FROM l_shipdate) = 1997
    GROUP BY l_partkey ORDER BY mean_quantity DESC, l_partkey LIMIT 20""")
def agg_avg_top(t: Tables) -> DataFrame:
    shipped = t.lineitem.where(in_year(F.col("l_shipdate"), 1997))
    means = shipped.groupBy("l_partkey").agg(mean("l_quantity", 2).alias("mean_quantity"))
    return means.orderBy(F.desc("mean_quantity"), "l_partkey").limit(20)


@query("""
    SELECT event_type, COUNT(DISTINCT user_id) AS n_users FROM events WHERE value > 10 GROUP BY event_type""")
def agg_count_distinct(t: Tables) -> DataFrame:
    return t.events.where(F.col("value") > 10).groupBy("event_type").agg(F.countDistinct("user_id").alias("n_users"))


@query("""
    SELECT o_orderstatus, COUNT(*) AS n_orders, COUNT(l_orderkey) AS n_with_returns
    FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey
    GROUP BY o_orderstatus""")
def agg_count_col(t: Tables) -> DataFrame:
    returned = keys_of(t.lineitem.where(F.col("l_returnflag") == "R"), "l_orderkey")
    joined = t.orders.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count("l_orderkey").alias("n_with_returns")
    )


@query("""
    SELECT event_type, COUNT(value) AS n_values, MAX(user_id) AS last_user FROM events GROUP BY event_type""")
def agg_dict(t: Tables) -> DataFrame:
    counted = t.events.groupBy("event_type").agg({"value": "count", "user_id": "max"})
    return counted.withColumnsRenamed({"count(value)": "n_values", "max(user_id)": "last_user"})


@query("""
    SELECT CAST(SUM(n) AS DOUBLE) / COUNT(n) AS mean_lines_per_order
    FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey)""")
def agg_of_agg(t: Tables) -> DataFrame:
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return per_order.agg((F.sum("n") / F.count("n")).alias("mean_lines_per_order"))


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@query("SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_orderstatus FROM orders")
def drop_dups(t: Tables) -> DataFrame:
    return t.orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"), "o_orderstatus").dropDuplicates()


@query("""
    SELECT user_id, event_day, event_id, event_type FROM (
        SELECT user_id, strftime(ts, '%Y-%m-%d') AS event_day, event_id, event_type,
               ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
        FROM events) WHERE rn = 1""")
def drop_dups_subset(t: Tables) -> DataFrame:
    days = t.events.withColumn("event_day", F.date_format("ts", "yyyy-MM-dd"))
    return one_per_key(days, ["user_id", "event_day"], ["ts", "event_id"]).select(
        "user_id", "event_day", "event_id", "event_type"
    )


@query("""
    SELECT 'orders' AS table_name, COUNT(*) AS row_count FROM orders
    UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem UNION ALL SELECT 'events', COUNT(*) FROM events""")
def load_report(t: Tables) -> DataFrame:
    return count_rows({"orders": t.orders, "lineitem": t.lineitem, "events": t.events})


# ---- windows ---------------------------------------------------------------------


@query("""
    SELECT o_custkey, o_orderkey, o_orderstatus FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
    WHERE rn = 1""")
def rn_first_per_key(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    ranked = t.orders.withColumn("rn", F.row_number().over(w))
    return ranked.where(F.col("rn") == 1).select("o_custkey", "o_orderkey", "o_orderstatus")


# ---- sort, limit, top-k ----------------------------------------------------------


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def topk(t: Tables) -> DataFrame:
    return t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT COUNT(*) AS n_rows FROM (SELECT * FROM lineitem LIMIT 5)")
def limit_rows(t: Tables) -> DataFrame:
    return t.lineitem.limit(5).agg(F.count(F.lit(1)).alias("n_rows"))


@query("""
    SELECT l_partkey, COUNT(*) AS n_lines FROM lineitem GROUP BY l_partkey ORDER BY n_lines DESC, l_partkey LIMIT 1""")
def top1_group(t: Tables) -> DataFrame:
    counted = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_lines"))
    return counted.orderBy(F.desc("n_lines"), "l_partkey").limit(1)


@query("""
    SELECT event_id, props->>'$.k' AS size_text FROM events
    ORDER BY TRY_CAST(props->>'$.k' AS INTEGER) DESC, event_id LIMIT 20""")
def topk_numeric_cast(t: Tables) -> DataFrame:
    sized = t.events.select("event_id", F.get_json_object("props", "$.k").alias("size_text"))
    return sized.orderBy(F.desc(F.col("size_text").try_cast("int")), "event_id").limit(20)


# ---- set operations --------------------------------------------------------------


@query("""
    SELECT 'customer' AS kind, c_custkey AS party_key, c_name AS party_name FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier""")
def union_all(t: Tables) -> DataFrame:
    parts = [
        t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name")),
        t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("party_name")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("""
    SELECT o_custkey, o_orderstatus FROM orders WHERE extract(year FROM o_orderdate) = 1997
    EXCEPT SELECT o_custkey, o_orderstatus FROM orders WHERE extract(year FROM o_orderdate) = 1998""")
def except_rows(t: Tables) -> DataFrame:
    def of_year(y: int) -> DataFrame:
        return t.orders.where(in_year(F.col("o_orderdate"), y)).select("o_custkey", "o_orderstatus")

    # Both sides are made distinct before they meet, so no key is hot in the join.
    return of_year(1997).distinct().subtract(of_year(1998).distinct())


@query("""
    SELECT l_returnflag, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) * CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS taxed
    FROM lineitem GROUP BY l_returnflag""")
def agg_sum_fine(t: Tables) -> DataFrame:
    """A sum of values with six digits after the point."""
    taxed = F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax")
    return t.lineitem.groupBy("l_returnflag").agg(total(taxed, 6).alias("taxed"))


@query("""
    SELECT custkey, MIN(price) AS least_price FROM (
        SELECT c_custkey AS custkey, CAST(NULL AS DOUBLE) AS price FROM customer UNION ALL SELECT o_custkey, o_totalprice FROM orders)
    GROUP BY custkey""")
def first_nulls_last(t: Tables) -> DataFrame:
    """A null price, here that of a customer as such, is not the cheapest."""
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), F.lit(None).cast("double").alias("least_price"))
    prices = t.orders.select(F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("least_price"))
    return one_per_key(customers.unionByName(prices), ["custkey"], ["least_price"])


@query("""
    SELECT p_partkey, md5(replace(replace(p_name, '\\', '\\\\'), ' ', '\\ ') || ' ' || p_brand || ' ' || coalesce(CASE WHEN p_size > 25 THEN 'big' END, '\\N')) AS key
    FROM part""")
def md5_key_of_text(t: Tables) -> DataFrame:
    """A key of parts that hold the separator, and of nulls."""
    key = text_key(F.col("p_name"), F.col("p_brand"), F.when(F.col("p_size") > 25, "big"), sep=" ")
    return t.part.select("p_partkey", key.alias("key"))


@query("""
    SELECT c_custkey, c_name, SUM(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS spent
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""")
def spend_by_customer(t: Tables) -> DataFrame:
    """Orders are added per customer before the name is looked up."""
    spent = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(total("o_totalprice", 2).alias("spent"))
    return spent.join(t.customer.select("c_custkey", "c_name"), "c_custkey").select("c_custkey", "c_name", "spent")
