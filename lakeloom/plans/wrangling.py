"""Questions about users: visits, periods between markers, sessions, spend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import timestamp_text
from lakeloom.operators.layout import keys_of, replicate
from lakeloom.operators.lookup import QueryTable
from lakeloom.operators.windows import mean_between_markers, running_sum
from lakeloom.plans.registry import query
from lakeloom.sources.tables import Tables

def _is(event_type: str):
    return F.col("event_type") == event_type


_PERIODS = """
    SELECT event_id, user_id, CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (
               PARTITION BY user_id ORDER BY {order} {frame} BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS period
    FROM events WHERE event_type = 'click' OR event_type = 'view'"""


def _home_and_click(t: Tables) -> DataFrame:
    return t.events.where(_is("click") | _is("view"))


@query(_PERIODS.format(order="ts DESC", frame="RANGE"))
def running_sum_range(t: Tables) -> DataFrame:
    marker = _is("view").cast("long")
    return running_sum(_home_and_click(t), ["user_id"], "ts", marker, "period", frame="range").select("event_id", "user_id", "period")


@query(_PERIODS.format(order="ts DESC, event_id", frame="ROWS"))
def running_sum_rows(t: Tables) -> DataFrame:
    marker = _is("view").cast("long")
    summed = running_sum(_home_and_click(t), ["user_id"], "ts", marker, "period", frame="rows", ties=["event_id"])
    return summed.select("event_id", "user_id", "period")


@query(_PERIODS.format(order="ts DESC, event_id", frame="ROWS"))
def running_sum_hot(t: Tables) -> DataFrame:
    """The rows of every key are split by time, as those of keys with very many rows are."""
    marker = _is("view").cast("long")
    summed = running_sum(_home_and_click(t), ["user_id"], "ts", marker, "period", frame="rows", ties=["event_id"], hot_rows=2)
    return summed.select("event_id", "user_id", "period")


@query(f"""
    SELECT CAST(SUM(n) AS DOUBLE) / COUNT(n) AS mean_events FROM (
        SELECT user_id, period, COUNT(*) AS n FROM (
            SELECT e.event_type, p.* FROM events e JOIN ({_PERIODS.format(order="ts DESC", frame="RANGE")}) p USING (event_id))
        WHERE event_type = 'click' GROUP BY user_id, period)""")
def avg_events_between(t: Tables) -> DataFrame:
    return mean_between_markers(t.events, "user_id", "ts", _is("click"), _is("view"))


@query("""
    SELECT DISTINCT props->>'$.k' AS item FROM events
    WHERE props->>'$.k' NOT IN (SELECT props->>'$.k' FROM events WHERE user_id = 8 AND event_type = 'view')""")
def items_not_visited(t: Tables) -> DataFrame:
    items = t.events.select("user_id", "event_type", F.get_json_object("props", "$.k").alias("item"))
    visited = keys_of(items.where((F.col("user_id") == 8) & _is("view")), "item")
    return keys_of(items, "item").join(visited, "item", "left_anti")


@query("""
    SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time, event_id, event_type, value
    FROM events WHERE user_id = 8""")
def session_items(t: Tables) -> DataFrame:
    sessions = QueryTable(t.events, ("user_id",), ("ts", "event_id"))
    return sessions.where(user_id=8).select("user_id", timestamp_text(F.col("ts")).alias("event_time"), "event_id", "event_type", "value")


@query("""SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND props->>'$.k' = '69'""")
def users_by_item(t: Tables) -> DataFrame:
    bought = t.events.where(_is("purchase")).select(F.get_json_object("props", "$.k").alias("item"), "user_id", "ts", "event_id")
    table = QueryTable.build(bought, ["item"], ["user_id"], written_by=["ts", "event_id"])
    return table.where(item="69").select("user_id")


@query("""
    SELECT c_name, o_orderkey, o_totalprice, n_name, r_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE o_totalprice > 400000""")
def star_big_spend(t: Tables) -> DataFrame:
    big = t.orders.where(F.col("o_totalprice") > 400000)
    return (
        big.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(replicate(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(replicate(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_name", "o_orderkey", "o_totalprice", "n_name", "r_name")
    )
