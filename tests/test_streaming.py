from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeloom.session import scratch_path
from lakeloom.sources.tables import inline_rows
from lakeloom.streaming.incremental import add_batch, compact_days, day_folders, fact_rows, load_new_files
from lakeloom.streaming.intervals import load_interval


def events(spark, *data):
    df = inline_rows(spark, data, "id bigint, time string, v int")
    return df.withColumn("time", F.col("time").cast("timestamp"))


@pytest.fixture
def paths(spark):
    return {n: scratch_path(spark, n) for n in ("landing", "target", "state")}


def test_each_event_once(spark, paths):
    first = events(spark, (1, "2024-01-01 10:00:00", 1), (1, "2024-01-01 10:00:00", 1), (2, "2024-01-02 00:00:00", 2))
    second = events(spark, (2, "2024-01-02 00:00:00", 2), (3, "2024-01-02 09:00:00", 3), (4, None, 4), (4, None, 4))

    def load():
        return load_new_files(spark, paths["landing"], first.schema, paths["target"], paths["state"], ["id"], "time")

    first.write.parquet(paths["landing"] + "/1")
    assert rows(load(), "id", "v") == [(1, 1), (2, 2)]
    second.write.parquet(paths["landing"] + "/2")
    assert rows(load(), "id", "v") == [(1, 1), (2, 2), (3, 3), (4, 4)]
    second.write.parquet(paths["landing"] + "/3")
    assert rows(load(), "id", "v") == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_small_batches_equal_one_batch(spark, paths):
    rows_in = spark.range(200).select((F.col("id") % 120).alias("id"), F.timestamp_seconds(F.col("id") % 120 * 3600).alias("time"), F.lit(1).alias("v"))
    rows_in.repartition(6).write.parquet(paths["landing"])
    loaded = load_new_files(
        spark, paths["landing"], rows_in.schema, paths["target"], paths["state"], ["id"], "time", files_per_batch=2
    )
    assert loaded.count() == 120 and loaded.select("id").distinct().count() == 120


def test_batch_can_run_again(spark, paths):
    batch = events(spark, (1, "2024-01-01 10:00:00", 1), (2, "2024-01-02 00:00:00", 2))
    for load_id in ("a-0", "a-0", "a-1"):
        add_batch(batch, paths["target"], load_id, ["id"], "time", ["time"])
    assert rows(fact_rows(spark, paths["target"], batch.schema), "id") == [(1,), (2,)]


def test_interval_reload(spark, paths):
    days = events(spark, (1, "2024-01-01 10:00:00", 1), (2, "2024-01-02 00:00:00", 2), (3, "2024-01-02 23:59:59", 3), (4, "2024-01-03 00:00:00", 4))
    load_interval(days, "time", date(2024, 1, 1), date(2024, 1, 4), paths["target"])
    fixed = days.withColumn("v", F.col("v") * 10)
    for _ in range(2):
        load_interval(fixed, "time", date(2024, 1, 2), date(2024, 1, 3), paths["target"])
        assert rows(spark.read.parquet(paths["target"]), "id", "v") == [(1, 1), (2, 20), (3, 30), (4, 4)]
    with pytest.raises(ValueError):
        load_interval(days, "time", date(2024, 1, 2), date(2024, 1, 2), paths["target"])


def test_days_that_became_empty(spark, paths):
    days = inline_rows(spark, [(i, f"2024-01-0{i}") for i in (1, 2, 3, 4)], "id int, day string").withColumn("time", F.col("day").cast("timestamp"))
    load_interval(days, "time", date(2024, 1, 1), date(2024, 1, 5), paths["target"])
    for _ in range(2):
        load_interval(days.where("id = 3"), "time", date(2024, 1, 2), date(2024, 1, 4), paths["target"])
        assert rows(spark.read.parquet(paths["target"]), "id") == [(1,), (3,), (4,)]


def test_compaction_keeps_rows_and_survives_a_break(spark, paths):
    schema = inline_rows(spark, [], "id int, time timestamp").schema

    def load(name, ids):
        batch = inline_rows(spark, [(i, f"2024-01-0{1 + i % 3}") for i in ids], "id int, day string")
        add_batch(batch.select("id", F.col("day").cast("timestamp").alias("time")), paths["target"], name, ["id"], "time", ["time"])

    def ids():
        return sorted(r.id for r in fact_rows(spark, paths["target"], schema).collect())

    def folders():
        return {day: len(day_folders(spark, path)) for day, path in sorted(day_folders(spark, paths["target"]).items())}

    for n in range(3):
        load(f"load-{n}", range(3 * n, 3 * n + 3))
    assert compact_days(spark, paths["target"], schema, date(2024, 1, 3)) == 2
    assert list(folders().values()) == [1, 1, 3]
    assert ids() == [*range(9)]
    load("late", [0, 9, 10])
    assert ids() == [*range(11)]
    # A run that stops after removing the sources of one day is finished by the next.
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(paths["target"]).getFileSystem(spark._jsc.hadoopConfiguration())
    day = "event_day=2024-01-01"
    sources = day_folders(spark, f"{paths['target']}/{day}")
    side = f"{paths['target']}/_compact/{day}"
    spark.read.schema(schema).parquet(*sources.values()).write.parquet(f"{side}/load_id=merged-x")
    out = system.create(path(f"{side}/_sources"))
    out.write(bytearray("\n".join(sources).encode()))
    out.close()
    system.delete(path(next(iter(sources.values()))), True)
    assert compact_days(spark, paths["target"], schema, date(2024, 1, 3)) == 1
    assert ids() == [*range(11)]
    assert compact_days(spark, paths["target"], schema, date(2024, 1, 3)) == 0


def test_hourly_json_files(spark, paths, tmp_path):
    """Each hour another log file; plays enter the fact table once."""
    schema = inline_rows(spark, [], "session bigint, item bigint, ms bigint, time timestamp").schema
    landing, archive = tmp_path / "logs", tmp_path / "done"
    landing.mkdir()
    for hour in range(3):
        lines = [f'{{"session": 1, "item": {i}, "ms": {i}, "time": "2018-11-0{1 + i // 4} 0{i}:00:00"}}' for i in range(hour * 2, hour * 2 + 4)]
        (landing / f"hour-{hour}.json").write_text("\n".join(lines))
        loaded = load_new_files(
            spark, str(landing), schema, paths["target"], paths["state"], ["session", "item"], "time",
            pattern="*.json", file_format="json", archive=str(archive),
        )
        assert rows(loaded, "item") == [(i,) for i in range(hour * 2 + 4)]
