"""Loads, upserts and round trips through files and stored tables."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.functions.exact import mean
from lakeloom.functions.text import timestamp_text
from lakeloom.functions.times import in_year
from lakeloom.operators.lookup import QueryTable
from lakeloom.operators.modeling import date_dimension
from lakeloom.operators.quality import Observed, observed_counts, require
from lakeloom.operators import upsert as conflicts
from lakeloom.operators.weblogs import parse_log, top_counts
from lakeloom.plans.logs import _LINES, log_lines
from lakeloom.plans.registry import query
from lakeloom.session import scratch_path
from lakeloom.sinks import catalog
from lakeloom.sinks.folders import apply_upsert
from lakeloom.sinks.files import write_csv, write_documents, write_parquet, write_partitioned
from lakeloom.sinks.ranged import RangedTable
from lakeloom.sources import files
from lakeloom.sources.jsonpaths import json_by_paths
from lakeloom.sources.quoted import csv_records
from lakeloom.sources.tables import Tables, inline_rows, stored_table
from lakeloom.streaming.eventtime import load_in_event_time
from lakeloom.streaming.incremental import compact_days, fact_rows, load_new_files
from lakeloom.streaming.intervals import load_interval

# ---- upserts ---------------------------------------------------------------------


@query("""
    SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL
    SELECT c_custkey, c_name, c_acctbal + 1 FROM customer
    WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def insert_ignore(t: Tables) -> DataFrame:
    columns = ["c_custkey", "c_name", "c_acctbal"]
    target = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(*columns)
    batch = t.customer.withColumn("c_acctbal", F.col("c_acctbal") + 1).select(*columns)
    return conflicts.insert_ignore(target, batch, ["c_custkey"], ["c_name"])


@query("""
    WITH items AS (SELECT user_id, props->>'$.k' AS item, event_type, value, ts, event_id FROM events),
    v AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, item ORDER BY ts, event_id) AS rn
                         FROM items WHERE event_type = 'view') WHERE rn = 1),
    c AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, item ORDER BY ts DESC, event_id DESC) AS rn
                         FROM items WHERE event_type = 'click') WHERE rn = 1)
    SELECT coalesce(v.user_id, c.user_id) AS user_id, coalesce(v.item, c.item) AS item,
           coalesce(c.event_type, v.event_type) AS event_type, coalesce(v.value, c.value) AS value
    FROM v FULL JOIN c ON v.user_id = c.user_id AND v.item = c.item""")
def upsert_items(t: Tables) -> DataFrame:
    """Views are known, clicks arrive: some pairs are updated, some are new."""
    keys = ["user_id", "item"]
    items = t.events.select("user_id", F.get_json_object("props", "$.k").alias("item"), "event_type", "value", "ts", "event_id")
    views = conflicts.one_per_key(items.where(F.col("event_type") == "view"), keys, ["ts", "event_id"])
    target = views.select(*keys, "event_type", "value")
    clicks = items.where(F.col("event_type") == "click")
    return conflicts.upsert(target, clicks, keys, ["event_type"], ["ts", "event_id"])


_LAST_WRITE = """
    SELECT user_id, event_type, event_id, value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1"""


def _last_events(t: Tables) -> QueryTable:
    columns = ["user_id", "event_type", "event_id", "value"]
    return QueryTable.build(t.events, ["user_id"], ["event_type"], written_by=["ts", "event_id"], columns=columns)


@query(_LAST_WRITE)
def lww_table(t: Tables) -> DataFrame:
    return _last_events(t).rows


@query(_LAST_WRITE + " AND user_id = 8")
def lww_table_lookup(t: Tables) -> DataFrame:
    return _last_events(t).store(scratch_path(t.spark, "last_events")).where(user_id=8)


@query(_LAST_WRITE)
def lww_table_merged(t: Tables) -> DataFrame:
    """Half of the events make the table, the other half is merged in, twice."""
    columns = ["user_id", "event_type", "event_id", "value", "ts"]
    events = t.events.select(*columns)
    later = F.col("event_id") % 2 == 1
    table = RangedTable.create(events.where(~later), scratch_path(t.spark, "last_events"), ["user_id"], ["event_type"], ["ts", "event_id"], ranges=8)
    for _ in range(2):
        table.merge(events.where(later))
    return table.rows(t.spark).drop("ts")


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    WHERE o_custkey = (SELECT MIN(o_custkey) FROM orders WHERE o_orderpriority = '1-URGENT') ORDER BY o_orderkey""")
def point_lookup_stored(t: Tables) -> DataFrame:
    """Orders of one customer from a stored table, by its key."""
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    table = RangedTable.create(orders, scratch_path(t.spark, "orders"), ["o_custkey"], ["o_orderkey"], ranges=8)
    wanted = t.orders.where(F.col("o_orderpriority") == "1-URGENT").agg(F.min("o_custkey")).first()[0]
    return table.where(t.spark, o_custkey=wanted)


# ---- round trips -----------------------------------------------------------------


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def parquet_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "suppliers")
    write_parquet(t.supplier, path)
    return t.spark.read.schema(t.supplier.schema).parquet(path)


@query("""
    SELECT o_orderkey, o_totalprice, year(o_orderdate) AS "year", month(o_orderdate) AS "month" FROM orders""")
def partitioned_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders")
    rows = t.orders.select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    write_partitioned(rows, path, ["year", "month"])
    return t.spark.read.schema(rows.schema).parquet(path)


@query("SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customers")
    columns = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]
    write_csv(t.customer, path, columns)
    return files.csv_files(t.spark, path, schema=t.customer.select(*columns).schema, header=True)


_EVENT_ROWS = "SELECT event_id, user_id, event_type, value FROM events"


def _event_documents(t: Tables) -> tuple[str, StructType]:
    """Events as JSON documents with names in mixed case."""
    path = scratch_path(t.spark, "event_documents")
    mixed = {"event_id": "eventId", "user_id": "userId", "event_type": "eventType", "value": "Value"}
    write_documents(t.events.select(*[F.col(c).alias(n) for c, n in mixed.items()]), path)
    return path, t.events.select(*mixed).schema


@query(_EVENT_ROWS)
def json_name_load(t: Tables) -> DataFrame:
    path, schema = _event_documents(t)
    target = StructType()
    for field in schema.fields:
        target = target.add(field.name.replace("_", ""), field.dataType)
    return files.json_by_name(t.spark, path, target).toDF(*schema.fieldNames())


@query(_EVENT_ROWS)
def jsonpath_load(t: Tables) -> DataFrame:
    path, schema = _event_documents(t)
    return json_by_paths(t.spark, path, ["$.eventId", "$.userId", "$['eventType']", "$.Value"], schema)


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def gzip_parts_load(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "parts")
    rows = t.part.select("p_partkey", "p_name", "p_retailprice")
    rows.write.options(sep=";", compression="gzip").csv(path)
    return files.gzip_parts(t.spark, f"{path}/part-", rows.schema)


@query("SELECT p_partkey, replace(p_name, ' ', ',') AS first_word, CAST(2 AS INTEGER) AS n_words, true AS last_is_null FROM part")
def array_literal_quoted(t: Tables) -> DataFrame:
    """A quoted element with commas, and a NULL."""
    listed = F.concat(F.lit('{"'), F.replace("p_name", F.lit(" "), F.lit(",")), F.lit('", NULL}'))
    words = files.array_literal("listed")
    read = t.part.select("p_partkey", listed.alias("listed")).select("p_partkey", words.alias("words"))
    return read.select("p_partkey", F.get("words", F.lit(0)).alias("first_word"), F.size("words").alias("n_words"), F.get("words", F.lit(1)).isNull().alias("last_is_null"))


@query("SELECT p_partkey, replace(p_name, ' ', chr(10)) AS name, p_brand FROM part")
def csv_multiline_load(t: Tables) -> DataFrame:
    """Quoted fields with line breaks in them."""
    path = scratch_path(t.spark, "multiline")
    rows = t.part.select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("\n")).alias("name"), "p_brand")
    write_csv(rows, path, multi_line=True)
    return files.csv_files(t.spark, path, schema=rows.schema, header=True, multi_line=True)


@query("""
    SELECT o_orderkey, o_orderstatus || chr(10) || '"' || o_orderpriority || '",' || chr(10) AS note, o_custkey FROM orders""")
def csv_multiline_split(t: Tables) -> DataFrame:
    """One large file with line breaks, quotes and commas in its texts, read in many blocks."""
    spark, path, read = t.spark, scratch_path(t.spark, "multiline"), scratch_path(t.spark, "records")
    note = F.concat("o_orderstatus", F.lit('\n"'), "o_orderpriority", F.lit('",\n'))
    rows = t.orders.select("o_orderkey", note.alias("note"), "o_custkey")
    write_csv(rows.coalesce(1), path, multi_line=True)
    # The tables here fill a fraction of an ordinary block; smaller ones cut the file.
    small = {"spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "4096"}
    old = {key: spark.conf.get(key) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        # One file for each small block would be many; the hint puts their records together.
        write_parquet(csv_records(spark, path, rows.schema, header=True).hint("rebalance"), read)
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    return spark.read.schema(rows.schema).parquet(read)


@query("SELECT p_partkey, list_aggregate(string_split(p_name, ' '), 'string_agg', '/') AS words FROM part")
def array_literal_load(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "words")
    listed = F.concat(F.lit("{"), F.replace("p_name", F.lit(" "), F.lit(",")), F.lit("}"))
    write_csv(t.part.select("p_partkey", listed.alias("words")), path)
    read = files.csv_files(t.spark, path, schema="p_partkey bigint, words string", header=True)
    return read.select("p_partkey", F.concat_ws("/", files.array_literal("words")).alias("words"))


@query(f"""
    SELECT split_part(line, ' ', 1) AS host, COUNT(*) AS n_rows FROM ({_LINES})
    WHERE line NOT LIKE 'garbled%' GROUP BY 1 ORDER BY n_rows DESC, host LIMIT 10""")
def text_log_load(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "access_log")
    log_lines(t).select("value").write.option("compression", "gzip").text(path)
    return top_counts(parse_log(files.text_lines(t.spark, path)), "host", 10)


def _folder_and_file(path: str):
    """The end of a path; readers spell a blank in it in two ways."""
    return F.replace(F.regexp_extract(path, "([^/]+/[^/]+)$", 1), F.lit("%20"), F.lit(" ")).alias("file")


@query("""
    SELECT o_orderpriority AS priority, COUNT(*) AS n_rows, true AS has_bytes FROM orders GROUP BY o_orderpriority""")
def file_manifest(t: Tables) -> DataFrame:
    """Orders are stored by priority; the manifest of the files that result is joined with
    the rows read from each of them."""
    path = scratch_path(t.spark, "orders_by_priority")
    write_partitioned(t.orders.select("o_orderkey", "o_orderpriority"), path, ["o_orderpriority"])
    found = files.manifest(t.spark, path, "*.parquet").select(_folder_and_file("path"), "length")
    read = t.spark.read.parquet(path).select("o_orderpriority", F.col("_metadata.file_path").alias("path"))
    # Rows are counted by whole path; its end is taken once for each file. It comes from an
    # aggregate, so the join's test for null does not take it from each row all the same.
    counted = read.groupBy("path", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.max("path").alias("whole"))
    rows = counted.select("o_orderpriority", "n", _folder_and_file("whole")).join(found, "file")
    by_priority = rows.groupBy(F.col("o_orderpriority").alias("priority"))
    return by_priority.agg(F.sum("n").alias("n_rows"), F.bool_and(F.col("length") > 0).alias("has_bytes"))


@query("""
    SELECT l_partkey, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_quantity) AS mean_quantity
    FROM lineitem WHERE extract(year FROM l_shipdate) = 1998
    GROUP BY l_partkey ORDER BY mean_quantity DESC, l_partkey LIMIT 20""")
def columnar_copy(t: Tables) -> DataFrame:
    """A row-oriented copy (CSV) turned into a compressed columnar one, then asked."""
    rows, columns = scratch_path(t.spark, "lines_csv"), scratch_path(t.spark, "lines_parquet")
    chosen = t.lineitem.select("l_partkey", "l_quantity", "l_shipdate")
    write_csv(chosen, rows)
    read = files.csv_files(t.spark, rows, schema=chosen.schema, header=True)
    write_parquet(read, columns, compression="zstd")
    shipped = t.spark.read.schema(chosen.schema).parquet(columns).where(in_year(F.col("l_shipdate"), 1998))
    means = shipped.groupBy("l_partkey").agg(mean("l_quantity", 2).alias("mean_quantity"))
    return means.orderBy(F.desc("mean_quantity"), "l_partkey").limit(20)


# ---- table loads -----------------------------------------------------------------


@query("""
    SELECT 'staging' AS table_name, COUNT(*) AS row_count FROM events
    UNION ALL SELECT 'facts', COUNT(*) FROM events WHERE event_type IN ('click', 'purchase')
    UNION ALL SELECT 'users', COUNT(DISTINCT user_id) FROM events
    UNION ALL SELECT 'dates', COUNT(DISTINCT CAST(ts AS DATE)) FROM events""")
def staged_load(t: Tables) -> DataFrame:
    """Create tables, stage, add two portions of facts, load dimensions, count."""
    spark, run = t.spark, uuid.uuid4().hex[:12]
    names = {n: f"{n}_{run}" for n in ("staging", "facts", "users", "dates")}
    events = t.events
    dates = date_dimension(events, "ts")
    schemas = {
        names["staging"]: events.schema,
        names["facts"]: events.select("event_id", "user_id", "value").schema,
        names["users"]: events.select("user_id").schema,
        names["dates"]: dates.schema,
    }
    catalog.create_tables(spark, schemas, scratch_path(spark, "staged_load"))
    catalog.stage_table(events, names["staging"])
    staging = spark.table(names["staging"])
    for event_type in ("click", "purchase"):
        catalog.load_fact(staging.where(F.col("event_type") == event_type), names["facts"])
    catalog.load_dimension(staging.select("user_id").distinct(), names["users"])
    catalog.load_dimension(date_dimension(staging, "ts"), names["dates"])
    # One number for each table, counted before the tables are dropped.
    counts = [(n, spark.table(full).count()) for n, full in names.items()]
    catalog.drop_tables(spark, list(names.values()))
    return inline_rows(spark, counts, "table_name string, row_count bigint")


@query("""
    SELECT 'loaded' AS step, COUNT(*) AS n_rows FROM orders
    UNION ALL SELECT 'selected', COUNT(*) FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'cleared', 0
    UNION ALL SELECT 'tables left', 0""")
def insert_select_drop(t: Tables) -> DataFrame:
    """Create and load a table, check it, select from it into another, clear it, drop both."""
    spark, run = t.spark, uuid.uuid4().hex[:12]
    source, chosen = f"orders_{run}", f"urgent_{run}"
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    orders = t.orders.select(*columns)
    folder = scratch_path(spark, "insert_select")
    require(catalog.create_and_load(orders, source, orders.schema, folder))
    catalog.create_tables(spark, {chosen: orders.schema}, folder)
    catalog.insert_select(stored_table(spark, source).where("o_orderpriority = '1-URGENT'"), chosen)
    steps = [("loaded", stored_table(spark, source).count()), ("selected", stored_table(spark, chosen).count())]
    catalog.clear_table(spark, source)
    steps.append(("cleared", stored_table(spark, source).count()))
    catalog.drop_tables(spark, [source, chosen])
    steps.append(("tables left", sum(spark.catalog.tableExists(n) for n in (source, chosen))))
    return inline_rows(spark, steps, "step string, n_rows bigint")


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def json_tree_load(t: Tables) -> DataFrame:
    """Documents in a tree of folders, below one root."""
    root = scratch_path(t.spark, "order_tree")
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    rows.withColumn("folder", F.col("o_orderkey") % 3).write.partitionBy("folder").json(root)
    return files.json_tree(t.spark, root, rows.schema)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_inferred_load(t: Tables) -> DataFrame:
    """Documents of a glob whose schema is inferred."""
    root = scratch_path(t.spark, "customer_documents")
    write_documents(t.customer.select("c_custkey", "c_name", "c_acctbal"), f"{root}/one")
    return files.json_glob(t.spark, f"{root}/*/*.json").select("c_custkey", "c_name", "c_acctbal")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def gzip_single_load(t: Tables) -> DataFrame:
    """One gzip file, spread over tasks after it is unpacked."""
    path = scratch_path(t.spark, "suppliers")
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    rows.coalesce(1).write.options(sep=";", compression="gzip").csv(path)
    return files.gzip_single(t.spark, path, rows.schema, partitions=4)


@query("""
    SELECT flag, meaning, COUNT(*) AS n_lines FROM lineitem
    JOIN (VALUES ('R', 'returned'), ('A', 'accepted'), ('N', 'open')) AS m(flag, meaning) ON l_returnflag = flag GROUP BY flag, meaning""")
def inline_rows_join(t: Tables) -> DataFrame:
    """Literal rows as a small table beside a large one, which is folded first."""
    meanings = inline_rows(t.spark, [("R", "returned"), ("A", "accepted"), ("N", "open")], "flag string, meaning string")
    counted = t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("n_lines"))
    return counted.join(meanings, "flag").select("flag", "meaning", "n_lines")


@query(_LAST_WRITE + " AND event_type = 'click'")
def lookup_without_key(t: Tables) -> DataFrame:
    """A filter that does not follow the table's key: a whole scan, which has to be asked for."""
    return _last_events(t).where(strict=False, event_type="click")


_EVENTS_TEXT = """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time, user_id, event_type, value, props FROM events"""


def _events_text(events: DataFrame) -> DataFrame:
    return events.select("event_id", timestamp_text(F.col("ts")).alias("event_time"), "user_id", "event_type", "value", "props")


def _days(events: DataFrame) -> tuple[date, date]:
    row = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    return row.first.date(), row.last.date()


@query(_EVENTS_TEXT)
def incremental_load(t: Tables) -> DataFrame:
    """Files arrive in two deliveries that overlap by days; a third run finds nothing.
    Every event is in the result once."""
    spark, events = t.spark, t.events
    landing, target, state = (scratch_path(spark, n) for n in ("landing", "facts", "load_state"))
    first, last = _days(events)
    middle = first + (last - first) / 2
    deliveries = (
        events.where(F.col("ts") < F.lit(f"{middle + timedelta(days=1)}").cast("timestamp_ntz")),
        events.where(F.col("ts") >= F.lit(f"{middle - timedelta(days=1)}").cast("timestamp_ntz")),
    )
    loaded = None
    for n, rows in enumerate(deliveries):
        write_parquet(rows, f"{landing}/delivery-{n}")
        loaded = load_new_files(spark, landing, events.schema, target, state, ["event_id"], "ts")
    loaded = load_new_files(spark, landing, events.schema, target, state, ["event_id"], "ts")
    return _events_text(loaded)


@query(_EVENTS_TEXT)
def interval_reload(t: Tables) -> DataFrame:
    """All days are stored, then one day is loaded again, twice."""
    target = scratch_path(t.spark, "event_days")
    first, last = _days(t.events)
    load_interval(t.events, "ts", first, last + timedelta(days=1), target)
    for _ in range(2):
        load_interval(t.events, "ts", first, first + timedelta(days=1), target)
    stored = t.spark.read.schema(StructType([*t.events.schema.fields]).add("event_day", "date")).parquet(target)
    return _events_text(stored)


@query(f"{_EVENTS_TEXT} WHERE CAST(ts AS DATE) > (SELECT MIN(CAST(ts AS DATE)) FROM events)")
def interval_reload_empty_day(t: Tables) -> DataFrame:
    """The first two days are loaded again, and the first has no rows any more."""
    target = scratch_path(t.spark, "event_days")
    first, last = _days(t.events)
    load_interval(t.events, "ts", first, last + timedelta(days=1), target)
    later = t.events.where(F.col("ts") >= F.lit(f"{first + timedelta(days=1)}").cast("timestamp_ntz"))
    load_interval(later, "ts", first, first + timedelta(days=2), target)
    return _events_text(t.spark.read.schema(StructType([*t.events.schema.fields]).add("event_day", "date")).parquet(target))


@query(_EVENTS_TEXT)
def incremental_compacted(t: Tables) -> DataFrame:
    """Two deliveries for every day, whose folders are then merged."""
    spark, events = t.spark, t.events
    landing, target, state = (scratch_path(spark, n) for n in ("landing", "facts", "load_state"))
    _, last = _days(events)
    for n in range(2):
        write_parquet(events.where(F.col("event_id") % 2 == n), f"{landing}/delivery-{n}")
        load_new_files(spark, landing, events.schema, target, state, ["event_id"], "ts")
    compact_days(spark, target, events.schema, last + timedelta(days=1))
    return _events_text(fact_rows(spark, target, events.schema))


_DELAY = timedelta(hours=36)


@query("""
    WITH cut AS (SELECT CAST(CAST(MIN(ts) AS DATE) + CAST((CAST(MAX(ts) AS DATE) - CAST(MIN(ts) AS DATE)) // 2 AS INTEGER) AS TIMESTAMP) AS middle FROM events),
    arrivals AS (
        SELECT 1 AS delivery, event_id, ts FROM events, cut WHERE ts < middle AND event_id % 10 NOT IN (3, 4)
        UNION ALL
        SELECT 2, event_id, ts FROM events, cut WHERE event_id % 10 <> 4 AND (ts >= middle - INTERVAL 1 DAY OR event_id % 10 = 3)
        UNION ALL
        SELECT 3, event_id, ts FROM events WHERE event_id % 10 IN (4, 7)),
    marks AS (
        SELECT a.delivery, MAX(make_timestamp((epoch_us(b.ts) // 1000) * 1000)) - INTERVAL 36 HOUR AS mark
        FROM (SELECT DISTINCT delivery FROM arrivals) a JOIN arrivals b ON b.delivery < a.delivery GROUP BY a.delivery),
    told AS (
        SELECT event_id, CASE WHEN ts <= mark THEN 'late' ELSE 'accepted' END AS outcome
        FROM arrivals LEFT JOIN marks USING (delivery))
    SELECT event_id, outcome, CASE WHEN outcome = 'late' THEN COUNT(*) ELSE 1 END AS n_rows FROM told GROUP BY event_id, outcome""")
def event_time_load(t: Tables) -> DataFrame:
    """Three deliveries: the second repeats a day and brings rows kept back from the first,
    the third repeats some rows and brings others far too late."""
    spark = t.spark
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = _days(t.events)
    cut = first + timedelta(days=(last - first).days // 2)
    paths = {n: scratch_path(spark, n) for n in ("landing", "accepted", "late", "load_state")}
    time, kind = F.col("ts"), F.col("event_id") % 10
    at, before = (F.lit(f"{d}").cast("timestamp") for d in (cut, cut - timedelta(days=1)))
    deliveries = [(time < at) & ~kind.isin(3, 4), (kind != 4) & ((time >= before) | (kind == 3)), kind.isin(4, 7)]
    accepted = late = None
    for n, condition in enumerate(deliveries):
        write_parquet(events.where(condition), f"{paths['landing']}/delivery-{n}")
        accepted, late = load_in_event_time(
            spark, paths["landing"], events.schema, paths["accepted"], paths["late"], paths["load_state"], ["event_id"], "ts", _DELAY
        )
    told = [rows.select("event_id", F.lit(outcome).alias("outcome")) for rows, outcome in ((accepted, "accepted"), (late, "late"))]
    return told[0].unionByName(told[1]).groupBy("event_id", "outcome").agg(F.count(F.lit(1)).alias("n_rows"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in ("orders", "lineitem", "customer")))
def load_report_observed(t: Tables) -> DataFrame:
    """Rows are counted in the passes that store the tables."""
    observed = [Observed(name) for name in ("orders", "lineitem", "customer")]
    for o in observed:
        write_parquet(getattr(t, o.table), scratch_path(t.spark, o.table), watch=o)
    return observed_counts(t.spark, observed)


def _segments(t: Tables) -> tuple[str, DataFrame, DataFrame]:
    """A stored table of the customers of two segments, by segment, and a batch of all."""
    columns = ["c_mktsegment", "c_custkey", "c_name", "c_acctbal"]
    customers = t.customer.select(*columns)
    target = scratch_path(t.spark, "customers")
    write_partitioned(customers.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")), target, ["c_mktsegment"])
    return target, customers, customers.where(F.col("c_mktsegment") != "MACHINERY").withColumn("c_acctbal", F.col("c_acctbal") + 1)


@query("""
    SELECT c_mktsegment, c_custkey, c_name, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_acctbal ELSE c_acctbal + 1 END AS c_acctbal
    FROM customer""")
def insert_ignore_stored(t: Tables) -> DataFrame:
    target, customers, batch = _segments(t)
    for _ in range(2):
        apply_upsert(target, batch, ["c_mktsegment", "c_custkey"], "c_mktsegment", ["c_name"])
    return t.spark.read.schema(customers.schema).parquet(target)


@query("""
    SELECT c_mktsegment, c_custkey, c_name, CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal ELSE c_acctbal + 1 END AS c_acctbal
    FROM customer""")
def upsert_stored(t: Tables) -> DataFrame:
    target, customers, batch = _segments(t)
    for _ in range(2):
        apply_upsert(target, batch, ["c_mktsegment", "c_custkey"], "c_mktsegment", ["c_name"], update=["c_acctbal"])
    return t.spark.read.schema(customers.schema).parquet(target)
