"""Files of every format, made from the tables and read back by the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.exact import total
from lakeloom.operators.layout import spread
from lakeloom.plans.questions import clean_events
from lakeloom.plans.registry import query
from lakeloom.session import scratch_path
from lakeloom.sinks.files import write_csv, write_documents
from lakeloom.sources import files
from lakeloom.sources.html import product_items
from lakeloom.sources.tables import Tables


@query("""
    SELECT CAST(s_suppkey AS VARCHAR) AS suppkey, s_name AS supplier, CAST(s_nationkey AS VARCHAR) AS nationkey FROM supplier""")
def csv_default_load(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "suppliers_csv")
    t.supplier.select("s_suppkey", "s_name", "s_nationkey").write.csv(path)
    read = files.csv_files(t.spark, path)
    return read.select(F.col("_c0").alias("suppkey"), F.col("_c1").alias("supplier"), F.col("_c2").alias("nationkey"))


_REVENUE = """
    SELECT month(o_orderdate) AS "month", CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders GROUP BY month(o_orderdate)"""


def _payments(t: Tables) -> tuple[str, DataFrame]:
    path = scratch_path(t.spark, "payments")
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("amount"), F.to_date("o_orderdate").alias("paid"))
    rows.write.options(sep=";", header=True).csv(path)
    return path, rows


def _monthly(payments: DataFrame) -> DataFrame:
    return payments.groupBy(F.month("paid").alias("month")).agg(total("amount", 2).alias("revenue"))


@query(_REVENUE)
def csv_schema_load(t: Tables) -> DataFrame:
    path, rows = _payments(t)
    return _monthly(files.csv_files(t.spark, path, schema=rows.schema, sep=";", header=True))


@query(_REVENUE)
def csv_inferred_load(t: Tables) -> DataFrame:
    path, _ = _payments(t)
    return _monthly(files.csv_files(t.spark, path, sep=";", header=True, infer=True))


@query("""
    SELECT p_brand, COUNT(*) AS n_lines FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 5000 GROUP BY p_brand""")
def gzip_tables_load(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "gzip_tables")
    columns = {
        "part": t.part.select("p_partkey", "p_brand"),
        "supplier": t.supplier.select("s_suppkey", "s_acctbal"),
        "lineitem": t.lineitem.select("l_partkey", "l_suppkey"),
    }
    for name, rows in columns.items():
        rows.write.options(sep="|", compression="gzip").csv(f"{root}/{name}")
    loaded = files.gzip_tables(t.spark, root, {name: rows.schema for name, rows in columns.items()})
    rich = loaded["supplier"].where(F.col("s_acctbal") > 5000)
    lines = loaded["lineitem"].join(rich, F.col("l_suppkey") == F.col("s_suppkey"))
    # Lines are counted per part before the brand is looked up.
    per_part = lines.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    branded = per_part.join(loaded["part"], F.col("l_partkey") == F.col("p_partkey"))
    return branded.groupBy("p_brand").agg(F.sum("n").alias("n_lines"))


@query("""
    SELECT COUNT(*) FILTER (WHERE event_type = 'error') AS n_empty, COUNT(*) FILTER (WHERE event_type = 'signup') AS n_null,
           COUNT(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS n_named FROM events""")
def empty_text_filter(t: Tables) -> DataFrame:
    """JSON keeps an empty text apart from a missing one."""
    path = scratch_path(t.spark, "listeners")
    kind = F.col("event_type")
    user = F.when(kind == "error", "").when(kind != "signup", F.col("user_id").cast("string"))
    write_documents(t.events.select("event_id", user.alias("userId")), path)
    read = files.json_glob(t.spark, path, "event_id bigint, userId string")
    user_id = F.col("userId")
    return read.agg(
        F.count_if(user_id == "").alias("n_empty"),
        F.count_if(user_id.isNull()).alias("n_null"),
        F.count_if(user_id.isNotNull() & (user_id != "")).alias("n_named"),
    )


@query("""
    SELECT 'artist ' || (props->>'$.k') AS artist, 'first' AS "firstName", 'F' AS gender, CAST(event_id AS VARCHAR) AS "itemInSession",
           'last, jr' AS "lastName", CAST(value AS VARCHAR) AS length, 'free' AS "level", 'San Jose, "CA"' AS location,
           CAST(user_id AS VARCHAR) AS "sessionId", event_type AS song, CAST(user_id AS VARCHAR) AS "userId"
    FROM events WHERE event_type <> 'view'""")
def clean_event_files(t: Tables) -> DataFrame:
    """Seventeen text columns through CSV; rows without an artist are dropped and eleven
    columns kept."""
    path = scratch_path(t.spark, "event_csv")
    known = {
        "artist": F.when(F.col("event_type") != "view", F.concat(F.lit("artist "), F.get_json_object("props", "$.k"))),
        "firstName": F.lit("first"),
        "gender": F.lit("F"),
        "itemInSession": F.col("event_id"),
        "lastName": F.lit("last, jr"),
        "length": F.col("value"),
        "level": F.lit("free"),
        "location": F.lit('San Jose, "CA"'),
        "sessionId": F.col("user_id"),
        "song": F.col("event_type"),
        "userId": F.col("user_id"),
        **{c: F.lit("x") for c in ("auth", "method", "page", "registration", "status", "ts")},
    }
    write_csv(t.events.select(*[c.cast("string").alias(n) for n, c in known.items()]), path)
    return clean_events(files.csv_files(t.spark, path, header=True))


_RATINGS = ("One", "Two", "Three", "Four", "Five")


@query("""
    SELECT p_partkey, p_name || ' & more' AS title, '£' || CAST(p_size AS VARCHAR) AS price,
           CASE WHEN p_size > 25 THEN 'In stock' ELSE '' END AS in_stock,
           CASE p_size % 5 WHEN 0 THEN 'One' WHEN 1 THEN 'Two' WHEN 2 THEN 'Three' WHEN 3 THEN 'Four' ELSE 'Five' END AS rating,
           'catalogue/' || p_partkey || '/index.html' AS url
    FROM part""")
def html_products(t: Tables) -> DataFrame:
    """Every part as a product card in a page that is not well-formed XML."""
    size = F.col("p_size")
    rating = F.element_at(F.array(*[F.lit(r) for r in _RATINGS]), size % 5 + 1)
    link = F.concat(F.lit("catalogue/"), F.col("p_partkey"), F.lit("/index.html"))
    page = F.concat(
        F.lit('<!DOCTYPE html><body><p>list<br><script>var t="</p>";</script><article class="product_pod"><div class="image_container">'),
        F.lit('<a href="'), link, F.lit('"><img alt="'), F.col("p_name"), F.lit(' &amp; more"></a></div><p class="star-rating '), rating,
        F.lit('"><i></i></p><div class="product_price"><p class="price_color">&pound;'), size.cast("string"), F.lit("</p>"),
        F.when(size > 25, '<p class="instock availability"><i></i>\n\n  In stock\n </p>').otherwise(""), F.lit("</div></article>"),
    )
    # Parts are few bytes, often of one file, and their pages much work: all cores share them.
    parts = spread(t.part.select("p_partkey", "p_name", "p_size"))
    items = product_items(parts.select("p_partkey", page.alias("html")), "p_partkey")
    return items.select("p_partkey", "title", "price", "in_stock", "rating", "url")
