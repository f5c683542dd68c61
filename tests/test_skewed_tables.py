"""Joins, windows and checks on tables in which one key holds a third of all rows, with
broadcasts off and skew splitting on, as large tables would run."""

import duckdb
import pytest
from conftest import TESTDATA
from test_queries import comparable

import __spark_entry__ as driver
from lakeloom.operators import layout

# A third of the lines has one order, part and supplier; of the orders one customer; of
# the events one user and another third one item.
SKEWED = {
    "lineitem": """
        SELECT * EXCLUDE (hot)
            REPLACE (if(hot, 338, l_orderkey) AS l_orderkey, if(hot, 7, l_partkey) AS l_partkey, if(hot, 3, l_suppkey) AS l_suppkey)
        FROM (SELECT *, row_number() OVER () % 3 = 0 AS hot FROM '{file}')""",
    "orders": "SELECT * REPLACE (if(o_orderkey % 3 = 0, 5, o_custkey) AS o_custkey) FROM '{file}'",
    "events": """
        SELECT * REPLACE (if(event_id % 3 = 0, 8, user_id) AS user_id, if(event_id % 3 = 1, '{{"k": 69}}', props) AS props) FROM '{file}'""",
}

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5000",
}

QUERIES = (
    "agg_avg_top", "agg_count_distinct", "avg_events_between", "denorm_sales_by_key", "dim_dedup_latest", "dq_orphans", "dq_unique",
    "drop_dups_subset", "except_rows", "fact_left", "fact_sales", "incremental_load", "insert_ignore", "join_3way", "join_anti",
    "join_left_multikey", "join_role_playing", "join_semi", "join_two_keys", "lookup_first_match", "lww_table", "normalize_3nf",
    "olap_cube", "olap_cube_base", "rn_first_per_key", "running_sum_range", "running_sum_rows", "ssb_same_dist_bucketed",
    "ssb_two_dim", "top1_group", "upsert_items", "users_by_item", "denorm_transactions", "dim_customer_history", "event_time_load",
    "lww_table_merged", "olap_cube_refreshed", "running_sum_hot", "star_songplays", "surrogate_key_incremental",
)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    if not TESTDATA.exists():
        pytest.skip("no test tables")
    folder = tmp_path_factory.mktemp("skewed")
    db = duckdb.connect()
    for file in TESTDATA.glob("*.parquet"):
        sql = SKEWED.get(file.stem, "SELECT * FROM '{file}'").format(file=file)
        db.execute(f"COPY ({sql}) TO '{folder}/{file.name}' (FORMAT parquet)")
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{folder}/{file.name}'")
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    bounds = layout.REPLICATE_BYTES, layout.REPLICATE_ROWS
    layout.REPLICATE_BYTES = layout.REPLICATE_ROWS = -1
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield str(folder), db
    layout.REPLICATE_BYTES, layout.REPLICATE_ROWS = bounds
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(name, spark, skewed):
    folder, db = skewed
    frame = driver.queries()[name](spark, folder)
    found = db.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert comparable(frame.columns, [tuple(r) for r in frame.collect()]) == comparable(columns, found.fetchall())
