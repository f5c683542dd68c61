"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_RUNS (timed runs).
Each query runs once untimed, then BENCH_RUNS times; the median counts. The two
stored layouts of the co-located join are compared too: ``layout`` holds load and
query seconds for plain and bucketed tables and the gain in percent.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame

from lakeloom.plans import ssb
from lakeloom.plans.catalog import REGISTRY
from lakeloom.session import get_spark, scratch_path
from lakeloom.sinks.files import write_parquet
from lakeloom.sources.tables import Tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "ssb_one_dim", "ssb_two_dim", "ssb_drill", "ssb_same_dist",
    "olap_cube_base", "olap_slice", "olap_dice", "olap_rollup", "olap_drilldown", "olap_grouping_sets", "olap_cube",
    "agg_avg_top", "monthly_revenue", "join_left_multikey", "join_role_playing", "lookup_first_match", "rn_first_per_key",
    "running_sum_range", "avg_events_between", "lww_table", "upsert_latest", "fact_left",
    "access_log_parse", "access_log_top", "html_links", "dq_orphans",
)


def timed(frame_of) -> float:
    start = time.perf_counter()
    frame: DataFrame = frame_of()
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(frame_of) -> float:
    timed(frame_of)
    return round(statistics.median(timed(frame_of) for _ in range(RUNS)), 4)


def layout_gain(spark) -> dict:
    """The co-located join on plain tables and on bucketed ones."""
    tables = Tables(spark, SF_DIR)
    start = time.perf_counter()
    lines, parts = scratch_path(spark, "plain_lines"), scratch_path(spark, "plain_parts")
    write_parquet(tables.lineitem.select("l_partkey", "l_shipdate", "l_extendedprice", "l_discount"), lines)
    write_parquet(tables.part.select("p_partkey"), parts)
    plain_load = time.perf_counter() - start
    start = time.perf_counter()
    bucketed = ssb.part_buckets(tables)
    bucketed_load = time.perf_counter() - start

    def plain() -> DataFrame:
        left, right = spark.read.parquet(lines), spark.read.parquet(parts)
        joined = left.join(right.hint("merge"), left.l_partkey == right.p_partkey)
        return ssb.by_ship_date(joined, ssb.discounted())

    plain_query, bucketed_query = median(plain), median(lambda: ssb.same_dist_join(*bucketed))
    return {
        "plain_load": round(plain_load, 3),
        "bucketed_load": round(bucketed_load, 3),
        "plain_query": plain_query,
        "bucketed_query": bucketed_query,
        "gain_percent": round(100 * (plain_query - bucketed_query) / plain_query, 1),
    }


def main() -> None:
    spark = get_spark(
        "bench",
        f"local[{CPUS}]",
        spark_sql_shuffle_partitions=CPUS,
        spark_driver_memory="16g",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: median(lambda name=name: REGISTRY[name](spark, SF_DIR)) for name in HEADLINE}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "layout": layout_gain(spark),
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
