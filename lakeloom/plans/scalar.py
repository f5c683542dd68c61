"""Scalar functions over text, numbers and times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from lakeloom.functions.exact import total
from lakeloom.functions.text import full_name, text_key, timestamp_text
from lakeloom.functions.times import WEEKDAY_STYLES, date_key as date_number, date_parts as parts_of, epoch_date as to_day
from lakeloom.functions.times import epoch_millis as to_millis, epoch_seconds as to_seconds, weekday
from lakeloom.plans.registry import query
from lakeloom.sources.jsonpaths import select_paths
from lakeloom.sources.tables import Tables

def _event_ms():
    return F.unix_millis(F.col("ts").cast("timestamp"))


@query("SELECT p_partkey, p_brand || ' ' || p_type AS label FROM part")
def str_concat(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", full_name("p_brand", "p_type").alias("label"))


@query("""
    SELECT event_id, md5(concat_ws('|', CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S.%f'),
                                   CAST(event_id AS VARCHAR))) AS event_key
    FROM events""")
def md5_key(t: Tables) -> DataFrame:
    key = text_key(F.col("user_id"), timestamp_text(F.col("ts")), F.col("event_id"))
    return t.events.select("event_id", key.alias("event_key"))


@query("""
    SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word,
           CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n_words FROM part""")
def str_split(t: Tables) -> DataFrame:
    words = F.split("p_name", " ")
    return t.part.select("p_partkey", words[0].alias("first_word"), F.size(words).cast("long").alias("n_words"))


@query("""
    SELECT c_custkey, replace(c_name, 'Customer#', '') AS number_text,
           trim(' ' || c_mktsegment || '  ') AS segment FROM customer""")
def str_trim_replace(t: Tables) -> DataFrame:
    padded = F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("  "))
    return t.customer.select(
        "c_custkey", F.replace("c_name", F.lit("Customer#"), F.lit("")).alias("number_text"), F.trim(padded).alias("segment")
    )


@query("SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders")
def date_key(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", date_number(F.col("o_orderdate")).alias("date_key"))


@query("SELECT event_id, strftime(make_timestamp((epoch_us(ts) // 1000000) * 1000000), '%Y-%m-%d %H:%M:%S') AS start_time FROM events")
def epoch_seconds(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.date_format(to_seconds(_event_ms()), "yyyy-MM-dd HH:mm:ss").alias("start_time"))


@query("SELECT event_id, strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d %H:%M:%S.%f') AS start_time FROM events")
def epoch_millis(t: Tables) -> DataFrame:
    return t.events.select("event_id", timestamp_text(to_millis(_event_ms())).alias("start_time"))


@query("SELECT event_id, strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d') AS event_date FROM events")
def epoch_date(t: Tables) -> DataFrame:
    return t.events.select("event_id", to_day(_event_ms()).cast("string").alias("event_date"))


@query("""
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS order_date, day(o_orderdate) AS "day", week(o_orderdate) AS "week",
           month(o_orderdate) AS "month", quarter(o_orderdate) AS "quarter", year(o_orderdate) AS "year",
           isodow(o_orderdate) - 1 AS "weekday", hour(o_orderdate) AS "hour" FROM orders""")
def date_parts(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    days = t.orders.select(day).distinct()
    return days.select(day.cast("date").cast("string").alias("order_date"), *parts_of(day), F.hour(day).alias("hour"))


@query("""
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS order_date, isodow(o_orderdate) - 1 AS monday0,
           dayofweek(o_orderdate) AS sunday0, dayofweek(o_orderdate) + 1 AS sunday1, isodow(o_orderdate) AS iso
    FROM orders""")
def weekday_styles(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    days = t.orders.select(day).distinct()
    return days.select(day.cast("date").cast("string").alias("order_date"), *[weekday(day, s).alias(s) for s in WEEKDAY_STYLES])


@query("""
    SELECT year(o_orderdate) AS "year", month(o_orderdate) AS "month",
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""")
def monthly_revenue(t: Tables) -> DataFrame:
    months = t.orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return months.agg(total("o_totalprice", 2).alias("revenue")).orderBy("year", "month")


@query("""
    SELECT event_id, m['type'] AS type_entry, m['k'] AS k_entry, m['absent'] AS absent_entry
    FROM (SELECT event_id, MAP {'type': event_type, 'k': props->>'$.k'} AS m FROM events)""")
def map_access(t: Tables) -> DataFrame:
    built = F.create_map(F.lit("type"), F.col("event_type"), F.lit("k"), F.get_json_object("props", "$.k"))
    mapped = t.events.select("event_id", built.alias("m"))
    return mapped.selectExpr("event_id", "m['type'] AS type_entry", "m['k'] AS k_entry", "m['absent'] AS absent_entry")


@query("SELECT event_id, TRY_CAST(props->>'$.k' AS BIGINT) AS k, TRY_CAST(props->>'$.none' AS BIGINT) AS missing FROM events")
def jsonpath_extract(t: Tables) -> DataFrame:
    target = StructType().add("k", LongType()).add("missing", LongType())
    return select_paths(t.events, "props", ["$.k", "$.none"], target, keep=["event_id"])
