"""Normal forms, dimensions, facts and data checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.exact import amount, net_revenue, total
from lakeloom.functions.text import text_key, timestamp_text
from lakeloom.operators import modeling, quality
from lakeloom.operators.dedup import dimension_rows, one_per_key
from lakeloom.operators.layout import keys_of, replicate, replicate_counted
from lakeloom.operators.history import first_history, merge_history
from lakeloom.operators.numbering import dense_keys, hashed_key, lasting_keys
from lakeloom.operators.upsert import upsert
from lakeloom.plans.olap import places
from lakeloom.plans.registry import query
from lakeloom.session import checkpointed, scratch_path
from lakeloom.sinks.files import write_parquet
from lakeloom.sources.tables import Tables, as_view

# The date from which loaded dimension rows are valid.
AS_OF = "2024-01-01"

# ---- keys and normal forms -------------------------------------------------------


@query("SELECT ROW_NUMBER() OVER (ORDER BY p_partkey) AS part_key, p_partkey, p_name FROM part")
def surrogate_key(t: Tables) -> DataFrame:
    return dense_keys(t.part.select("p_partkey", "p_name"), ["p_partkey"], "part_key")


@query("""
    SELECT ROW_NUMBER() OVER (ORDER BY p_partkey % 3, p_partkey) + 100 AS part_key, p_partkey FROM part""")
def surrogate_key_incremental(t: Tables) -> DataFrame:
    """Three batches of keys, each with those before; the last one comes twice."""
    known = None
    for n in (1, 2, 3, 3):
        batch = t.part.where(F.col("p_partkey") % 3 < n)
        known = checkpointed(lasting_keys(batch, known, ["p_partkey"], "part_key", first=101))
    return known.select("part_key", "p_partkey")


@query("SELECT md5(concat_ws('|', p_brand, CAST(p_partkey AS VARCHAR), p_type)) AS part_key, p_partkey FROM part")
def hashed_key_part(t: Tables) -> DataFrame:
    return hashed_key(t.part, ["p_brand", "p_partkey", "p_type"], "part_key").select("part_key", "p_partkey")


_WORDS = """
    SELECT p_partkey, p_brand, unnest(range(len(string_split(p_name, ' ')))) AS pos, unnest(string_split(p_name, ' ')) AS word
    FROM part"""


def _words(t: Tables) -> DataFrame:
    listed = t.part.select("p_partkey", "p_brand", F.split("p_name", " ").alias("words"))
    return modeling.first_normal_form(listed, "words", "word", "pos")


@query(_WORDS)
def explode_1nf(t: Tables) -> DataFrame:
    return _words(t)


@query(f"""
    SELECT 'words' AS "table", ROW_NUMBER() OVER (ORDER BY p_partkey, pos) AS word_id, word, p_partkey, CAST(NULL AS VARCHAR) AS p_brand FROM ({_WORDS})
    UNION ALL SELECT DISTINCT 'parts', NULL, NULL, p_partkey, p_brand FROM ({_WORDS})""")
def normalize_2nf(t: Tables) -> DataFrame:
    """Both tables of the split: parents, and children with an id each."""
    parents, children = modeling.second_normal_form(_words(t), "p_partkey", "word", "word_id", "pos")
    both = children.withColumn("table", F.lit("words")).unionByName(parents.withColumn("table", F.lit("parts")), allowMissingColumns=True)
    return both.select("table", "word_id", "word", "p_partkey", "p_brand")


_SEGMENTS = "SELECT c_mktsegment, ROW_NUMBER() OVER (ORDER BY c_mktsegment) AS segment_id FROM (SELECT DISTINCT c_mktsegment FROM customer)"


@query(f"""
    SELECT 'customers' AS "table", c_custkey, c_name, segment_id, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer JOIN ({_SEGMENTS}) USING (c_mktsegment)
    UNION ALL SELECT 'segments', NULL, NULL, segment_id, c_mktsegment FROM ({_SEGMENTS})""")
def normalize_3nf(t: Tables) -> DataFrame:
    """Both tables of the split: rows with a reference, and the values it refers to."""
    rows, values = modeling.third_normal_form(t.customer.select("c_custkey", "c_name", "c_mktsegment"), "c_mktsegment", "segment_id")
    both = rows.withColumn("table", F.lit("customers")).unionByName(values.withColumn("table", F.lit("segments")), allowMissingColumns=True)
    return both.select("table", "c_custkey", "c_name", "segment_id", "c_mktsegment")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def renormalize_roundtrip(t: Tables) -> DataFrame:
    source = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    rows, segments = modeling.third_normal_form(source, "c_mktsegment", "segment_id")
    return modeling.rebuild(rows, segments, "segment_id", source.columns)


@query("""
    SELECT s_suppkey, s_name, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_suppkey, s_name""")
def denorm_sales_by_key(t: Tables) -> DataFrame:
    sales = t.lineitem.groupBy("l_suppkey").agg(total("l_extendedprice", 2).alias("amount"))
    return sales.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("s_suppkey", "s_name", "amount")


@query("""
    SELECT o_orderkey, c_name, o_orderpriority, year(o_orderdate) AS "year", n_lines, amount
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN (SELECT l_orderkey, COUNT(*) AS n_lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
          FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""")
def denorm_transactions(t: Tables) -> DataFrame:
    """One wide row for each transaction: who, when, how much. Lines are added up first, so
    each join brings one row for a transaction."""
    sums = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), total("l_extendedprice", 2).alias("amount"))
    customers = replicate(t.customer.select("c_custkey", "c_name"))
    orders = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    joined = orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select("o_orderkey", "c_name", "o_orderpriority", F.year("o_orderdate").alias("year"), "n_lines", "amount")


# ---- dimensions ------------------------------------------------------------------


@query("""
    SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, strftime(o_orderdate, '%Y-%m-%d') AS "date",
           year(o_orderdate) AS "year", quarter(o_orderdate) AS "quarter", month(o_orderdate) AS "month",
           day(o_orderdate) AS "day", week(o_orderdate) AS "week", isodow(o_orderdate) IN (6, 7) AS is_weekend
    FROM orders""")
def dim_date(t: Tables) -> DataFrame:
    return modeling.date_dimension(t.orders, "o_orderdate").withColumn("date", F.col("date").cast("string"))


@query("""
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS start_time, hour(s) AS "hour", day(s) AS "day", week(s) AS "week",
           month(s) AS "month", year(s) AS "year", isodow(s) - 1 AS "weekday"
    FROM (SELECT DISTINCT make_timestamp((epoch_us(ts) // 1000) * 1000) AS s FROM events)""")
def dim_time(t: Tables) -> DataFrame:
    events = t.events.select(F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return modeling.time_dimension(events, "ms").withColumn("start_time", timestamp_text(F.col("start_time")))


def customer_dimension(t: Tables) -> DataFrame:
    homes = t.customer.join(places(t), F.col("c_nationkey") == F.col("n_nationkey"))
    attributes = {"name": "c_name", "segment": "c_mktsegment", "nation": "n_name", "region": "r_name"}
    return modeling.entity_dimension(homes, "c_custkey", "customer_key", attributes, AS_OF)


def part_dimension(t: Tables) -> DataFrame:
    attributes = {"name": "p_name", "brand": "p_brand", "type": "p_type", "size": "p_size"}
    return modeling.entity_dimension(t.part, "p_partkey", "part_key", attributes)


def store_dimension(t: Tables) -> DataFrame:
    homes = t.supplier.join(places(t), F.col("s_nationkey") == F.col("n_nationkey"))
    attributes = {"name": "s_name", "nation": "n_name", "region": "r_name"}
    return modeling.entity_dimension(homes, "s_suppkey", "store_key", attributes, AS_OF)


def _dates_as_text(dim: DataFrame) -> DataFrame:
    return dim.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})


@query(f"""
    SELECT ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key, c_custkey, c_name AS "name", c_mktsegment AS segment,
           n_name AS nation, r_name AS region, '{AS_OF}' AS start_date, CAST(NULL AS VARCHAR) AS end_date
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def dim_customer(t: Tables) -> DataFrame:
    return _dates_as_text(customer_dimension(t))


@query("""
    SELECT ROW_NUMBER() OVER (ORDER BY p_partkey) AS part_key, p_partkey, p_name AS "name", p_brand AS brand,
           p_type AS "type", p_size AS "size" FROM part""")
def dim_part(t: Tables) -> DataFrame:
    return part_dimension(t)


@query(f"""
    SELECT ROW_NUMBER() OVER (ORDER BY s_suppkey) AS store_key, s_suppkey, s_name AS "name", n_name AS nation,
           r_name AS region, '{AS_OF}' AS start_date, CAST(NULL AS VARCHAR) AS end_date
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def dim_store(t: Tables) -> DataFrame:
    return _dates_as_text(store_dimension(t))


@query("""
    WITH batches AS (
        SELECT DATE '2024-01-01' AS day, c_custkey, c_name, c_mktsegment AS segment FROM customer WHERE c_custkey % 5 <> 0
        UNION ALL
        SELECT DATE '2024-02-01', c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN 'MOVED' ELSE c_mktsegment END FROM customer
        UNION ALL
        SELECT DATE '2024-03-01', c_custkey, c_name, CASE WHEN c_custkey % 11 = 0 THEN 'LEFT' WHEN c_custkey % 7 = 0 THEN 'MOVED' ELSE c_mktsegment END
        FROM customer WHERE c_custkey % 13 <> 0),
    changes AS (
        SELECT *, LAG(segment) OVER (PARTITION BY c_custkey ORDER BY day) AS before FROM batches)
    SELECT c_custkey, c_name, segment, CAST(day AS VARCHAR) AS start_date,
           CAST(COALESCE(LEAD(day) OVER (PARTITION BY c_custkey ORDER BY day), CASE WHEN c_custkey % 13 = 0 THEN DATE '2024-03-01' END) AS VARCHAR) AS end_date
    FROM changes WHERE before IS DISTINCT FROM segment""")
def dim_customer_history(t: Tables) -> DataFrame:
    """Three dated lists of customers, the last one twice: segments change, customers come and go."""
    customers = t.customer.select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))
    key, attributes = F.col("c_custkey"), ["c_name", "segment"]
    moved = customers.withColumn("segment", F.when(key % 7 == 0, "MOVED").otherwise(F.col("segment")))
    left = moved.withColumn("segment", F.when(key % 11 == 0, "LEFT").otherwise(F.col("segment")))
    history = first_history(customers.where(key % 5 != 0), "c_custkey", attributes, date(2024, 1, 1))
    last = left.where(key % 13 != 0)
    for day, batch in ((date(2024, 2, 1), moved), (date(2024, 3, 1), last), (date(2024, 3, 1), last)):
        history = checkpointed(merge_history(history, batch, "c_custkey", attributes, day, whole=True))
    return _dates_as_text(history)


_RANKED = """
    SELECT user_id, event_type FROM (
        SELECT user_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {order}) AS rn FROM events)
    WHERE rn = 1"""


@query(_RANKED.format(order="event_type"))
def dim_dedup_first(t: Tables) -> DataFrame:
    return dimension_rows(t.events, "user_id", ["event_type"], policy="first_sorted")


@query(_RANKED.format(order="ts DESC, event_id DESC"))
def dim_dedup_latest(t: Tables) -> DataFrame:
    return dimension_rows(t.events, "user_id", ["event_type"], policy="latest", order_by=["ts", "event_id"])


@query("SELECT DISTINCT user_id, event_type FROM events WHERE user_id IS NOT NULL")
def dim_dedup_distinct(t: Tables) -> DataFrame:
    return dimension_rows(t.events, "user_id", ["event_type"], policy="distinct")


# ---- users kept by upsert, and facts ---------------------------------------------


def user_table(t: Tables) -> DataFrame:
    """First event of each user, brought up to date by the last one: its type changes,
    its value stays."""
    rows = t.events.select("user_id", "event_type", "value", "ts", "event_id")
    first = one_per_key(rows, ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "value")
    return upsert(first, rows, ["user_id"], ["event_type"], ["ts", "event_id"])


_USERS = """
    SELECT f.user_id, l.event_type, f.value FROM
      (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1) f
      JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                           FROM events) WHERE rn = 1) l ON f.user_id = l.user_id"""


@query(_USERS)
def upsert_latest(t: Tables) -> DataFrame:
    return user_table(t)


_PLAYS = f"""
    SELECT md5(concat_ws('|', CAST(e.user_id AS VARCHAR), strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f'), CAST(e.event_id AS VARCHAR)))
             AS play_key, e.event_id, e.user_id, u.event_type AS user_type
    FROM events e {{join}} JOIN ({_USERS}) u
      ON e.user_id = u.user_id AND CAST(e.value AS DECIMAL(18,0)) = CAST(u.value AS DECIMAL(18,0))
    WHERE e.event_type = 'click'"""


def _plays(t: Tables, how: str) -> DataFrame:
    clicks = t.events.where(F.col("event_type") == "click").withColumn("rounded", amount("value", 0))
    users = user_table(t).select("user_id", F.col("event_type").alias("user_type"), amount("value", 0).alias("rounded"))
    key = text_key(F.col("user_id"), timestamp_text(F.col("ts")), F.col("event_id"))
    return clicks.join(users, ["user_id", "rounded"], how).select(key.alias("play_key"), "event_id", "user_id", "user_type")


@query(_PLAYS.format(join="LEFT"))
def fact_left(t: Tables) -> DataFrame:
    return _plays(t, "left")


@query(_PLAYS.format(join=""))
def fact_inner(t: Tables) -> DataFrame:
    return _plays(t, "inner")


@query("""
    SELECT l_orderkey, l_linenumber, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
           customer_key, part_key, store_key,
           CAST(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS DOUBLE) AS sales_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key FROM customer) ON o_custkey = c_custkey
    JOIN (SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY p_partkey) AS part_key FROM part) ON l_partkey = p_partkey
    JOIN (SELECT s_suppkey, ROW_NUMBER() OVER (ORDER BY s_suppkey) AS store_key FROM supplier) ON l_suppkey = s_suppkey""")
def fact_sales(t: Tables) -> DataFrame:
    customers = replicate_counted(customer_dimension(t).select("c_custkey", "customer_key"))
    parts = replicate_counted(part_dimension(t).select("p_partkey", "part_key"))
    stores = replicate_counted(store_dimension(t).select("s_suppkey", "store_key"))
    dates = replicate_counted(checkpointed(modeling.date_dimension(t.orders, "o_orderdate").select("date", "date_key")))
    orders = (
        t.orders.withColumn("date", F.to_date("o_orderdate"))
        .join(dates, "date")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "date_key", "customer_key")
    )
    return (
        t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "date_key",
            "customer_key",
            "part_key",
            "store_key",
            amount(net_revenue(), 4).cast("double").alias("sales_amount"),
        )
    )


# ---- data checks -----------------------------------------------------------------


def _report_sql(*rows: tuple[str, str, str]) -> str:
    """SQL of a report from (table, check, query of the failing count)."""
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, CAST(n AS BIGINT) AS failing_rows, n = 0 AS passed FROM ({sql})"
        for table, check, sql in rows
    )


def _empty_sql(table: str) -> str:
    return f"SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS n FROM {table}"


def _null_sql(table: str, column: str) -> str:
    return f"SELECT COUNT(*) AS n FROM {table} WHERE {column} IS NULL"


@query(_report_sql(*[(x, "has_rows", _empty_sql(x)) for x in ("orders", "lineitem", "events", "customer")]))
def dq_has_rows(t: Tables) -> DataFrame:
    return quality.has_rows({"orders": t.orders, "lineitem": t.lineitem, "events": t.events, "customer": t.customer})


_RETURNS = """(SELECT o_orderkey, l_orderkey AS return_key FROM orders LEFT JOIN
    (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey)"""


@query(_report_sql(*[("order_returns", f"not_null:{c}", _null_sql(_RETURNS, c)) for c in ("o_orderkey", "return_key")]))
def dq_null_ids(t: Tables) -> DataFrame:
    returned = keys_of(t.lineitem.where(F.col("l_returnflag") == "R"), "l_orderkey")
    joined = t.orders.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return quality.no_nulls(joined.withColumn("return_key", F.col("l_orderkey")), "order_returns", ["o_orderkey", "return_key"])


@query(_report_sql(*[("events", f"not_null:{c}", _null_sql("events", c)) for c in ("event_id", "ts", "user_id", "event_type")]))
def dq_not_null(t: Tables) -> DataFrame:
    return quality.no_nulls(t.events, "events", ["event_id", "ts", "user_id", "event_type"])


@query(_report_sql(
    ("orders", "expected_value", "SELECT CASE WHEN COUNT(*) = 0 THEN 0 ELSE 1 END AS n FROM orders WHERE o_orderkey IS NULL"),
    ("orders", "expected_value", "SELECT CASE WHEN COUNT(*) = 0 THEN 0 ELSE 1 END AS n FROM orders WHERE o_totalprice > 0"),
))
def dq_expected(t: Tables) -> DataFrame:
    as_view(t.orders, "lakeloom_orders")
    return quality.all_of(
        [
            quality.expected_value(t.spark, "orders", f"SELECT count(*) FROM lakeloom_orders WHERE {condition}", 0)
            for condition in ("o_orderkey IS NULL", "o_totalprice > 0")
        ]
    )


def _repeated_sql(table: str, keys: str) -> str:
    return f"SELECT COUNT(*) AS n FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING COUNT(*) > 1)"


@query(_report_sql(
    ("orders", "unique:o_orderkey", _repeated_sql("orders", "o_orderkey")),
    ("lineitem", "unique:l_orderkey,l_linenumber", _repeated_sql("lineitem", "l_orderkey, l_linenumber")),
))
def dq_unique(t: Tables) -> DataFrame:
    return quality.all_of(
        [
            quality.unique_key(t.orders, "orders", ["o_orderkey"]),
            quality.unique_key(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"]),
        ]
    )


def _orphan_sql(child: str, key: str, parent: str, parent_key: str) -> str:
    return f"SELECT COUNT(*) AS n FROM {child} WHERE {key} NOT IN (SELECT {parent_key} FROM {parent})"


_URGENT = "(SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"


@query(_report_sql(
    ("lineitem", "orphan:l_orderkey", _orphan_sql("lineitem", "l_orderkey", "orders", "o_orderkey")),
    ("lineitem_urgent", "orphan:l_orderkey", _orphan_sql("lineitem", "l_orderkey", _URGENT, "o_orderkey")),
    ("orders", "orphan:o_custkey", _orphan_sql("orders", "o_custkey", "customer", "c_custkey")),
))
def dq_orphans(t: Tables) -> DataFrame:
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return quality.all_of(
        [
            quality.no_orphans(t.lineitem, "lineitem", "l_orderkey", t.orders, "o_orderkey"),
            quality.no_orphans(t.lineitem, "lineitem_urgent", "l_orderkey", urgent, "o_orderkey"),
            quality.no_orphans(t.orders, "orders", "o_custkey", t.customer, "c_custkey"),
        ]
    )


@query(_report_sql(
    ("events", "volume", "SELECT CASE WHEN COUNT(*) < 100 THEN 1 ELSE 0 END AS n FROM events"),
    ("events", "fresh:ts", "SELECT CASE WHEN MAX(ts) >= TIMESTAMP '2024-01-02' THEN 0 ELSE 1 END AS n FROM events"),
    ("events", "fresh:ts", "SELECT CASE WHEN MAX(ts) >= TIMESTAMP '2099-01-01' THEN 0 ELSE 1 END AS n FROM events"),
    ("lineitem", "bounds:l_discount", "SELECT COUNT(*) AS n FROM lineitem WHERE NOT l_discount BETWEEN 0.0 AND 0.09"),
))
def dq_freshness(t: Tables) -> DataFrame:
    recent = [quality.rows_between(100), *[quality.newest_from("ts", f"{day} 00:00:00") for day in ("2024-01-02", "2099-01-01")]]
    discounts = quality.in_one_scan(t.lineitem, "lineitem", [quality.bounded("l_discount", 0.0, 0.09)])
    return quality.in_one_scan(t.events, "events", recent).unionByName(discounts)


@query(_report_sql(
    ("orders", "has_rows", _empty_sql("orders")),
    ("orders", "not_null:o_custkey", _null_sql("orders", "o_custkey")),
    ("orders", "bounds:o_totalprice", "SELECT COUNT(*) AS n FROM orders WHERE NOT o_totalprice BETWEEN 1000.0 AND 400000.0"),
    ("orders", "fresh:o_orderdate", "SELECT CASE WHEN MAX(o_orderdate) >= TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END AS n FROM orders"),
    ("events", "volume", "SELECT CASE WHEN COUNT(*) > 5 THEN 1 ELSE 0 END AS n FROM events"),
    ("events", "not_null:user_id", _null_sql("events", "user_id")),
    ("events", "not_null:event_type", _null_sql("events", "event_type")),
    ("events", "fresh:ts", "SELECT CASE WHEN MAX(ts) >= TIMESTAMP '2099-01-01' THEN 0 ELSE 1 END AS n FROM events"),
))
def dq_one_pass(t: Tables) -> DataFrame:
    """All checks of two tables in the passes that write them; nothing is read again."""
    checks = {
        "orders": [quality.rows_there(), quality.null_free("o_custkey"), quality.bounded("o_totalprice", 1000.0, 400000.0), quality.newest_from("o_orderdate", "1998-01-01 00:00:00")],
        "events": [quality.rows_between(0, 5), quality.null_free("user_id"), quality.null_free("event_type"), quality.newest_from("ts", "2099-01-01 00:00:00")],
    }
    reports = []
    for name, wanted in checks.items():
        observed = quality.Observed(name, wanted)
        write_parquet(getattr(t, name), scratch_path(t.spark, name), watch=observed)
        reports.append(observed.report())
    return quality.all_of(reports)
