import contextlib
import random

import pytest
from conftest import plan_text, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.operators.dedup import dimension_rows, last_write_wins, one_per_key
from lakeloom.operators.windows import mean_between_markers, prefix_sums, running_sum
from lakeloom.plans import questions
from lakeloom.sources.tables import inline_rows


@pytest.fixture(scope="module")
def visits(spark):
    """One user has a third of all rows; times repeat; some users and times are null."""
    rng = random.Random(5)
    data = []
    for i in range(900):
        user = 1 if i % 3 == 0 else rng.choice([None, *range(2, 40)])
        second = None if i % 101 == 0 else rng.randrange(0, 5 * 86400, 500)
        data.append((i, user, second, rng.choice(["Home", "NextSong"])))
    df = inline_rows(spark, data, "id int, user int, second int, page string")
    return df.withColumn("time", F.timestamp_seconds(F.col("second") + 1541030400)).cache()


@pytest.mark.parametrize("hot_rows", [1, 100, 10**6])
@pytest.mark.parametrize("frame", ["rows", "range"])
@pytest.mark.parametrize("descending", [True, False])
def test_running_sum_equals_plain_window(visits, hot_rows, frame, descending):
    by = F.desc_nulls_last("time") if descending else F.asc_nulls_first("time")
    w = Window.partitionBy("user")
    if frame == "rows":
        w = w.orderBy(by, "id").rowsBetween(Window.unboundedPreceding, 0)
    else:
        w = w.orderBy(by).rangeBetween(Window.unboundedPreceding, 0)
    value = (F.col("page") == "Home").cast("long")
    want = visits.select("id", F.sum(value).over(w).alias("s"))
    got = running_sum(
        visits, ["user"], "time", value, "s", frame=frame, ties=["id"], descending=descending, hot_rows=hot_rows
    )
    assert rows(got, "id", "s") == rows(want)


@contextlib.contextmanager
def many_ranges(spark):
    """Small shuffles keep their partitions, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("frame", ["rows", "range"])
def test_a_hot_key_with_all_rows_in_one_moment(spark, frame):
    """No task holds more than a part of its rows, and the sums are those of one window."""
    n = 8000
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 != 0, 1).alias("u"), F.lit(5).alias("t"), (F.col("id") % 4).alias("v"))
    with many_ranges(spark):
        got = running_sum(df, ["u"], "t", F.col("v"), "s", frame=frame, ties=["id"], hot_rows=100).collect()
        parts = prefix_sums(df, ["u"], [F.asc("t"), F.asc("id")], "v", "s").groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in parts.collect()) < n / 3
    w = Window.partitionBy("u").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    w = w if frame == "rows" else Window.partitionBy("u").orderBy("t").rangeBetween(Window.unboundedPreceding, 0)
    assert sorted(((r.id, r.s) for r in got), key=repr) == rows(df.select("id", F.sum("v").over(w).alias("s")))


def test_input_is_read_twice_at_most(spark, tmp_path):
    """Once for the counts of keys; then once for the window, or once to split hot keys off."""
    spark.range(3000).select("id", (F.col("id") % 5).alias("u"), F.col("id").alias("t")).write.parquet(str(tmp_path / "in"))
    for hot_rows in (10, 10**6):
        read = spark.sparkContext.accumulator(0)

        def seen(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        df = spark.read.parquet(str(tmp_path / "in")).mapInArrow(seen, "id bigint, u bigint, t bigint")
        assert running_sum(df, ["u"], "t", F.lit(1), "s", ties=["id"], hot_rows=hot_rows).where("s > 0").count() == 3000
        assert read.value <= 2 * 3000


def test_frames_differ_only_on_equal_times(spark):
    df = inline_rows(spark, [(1, 1, 10, 1), (2, 1, 10, 1), (3, 1, 20, 1)], "id int, u int, s int, v int")
    df = df.withColumn("t", F.timestamp_seconds("s"))

    def sums(frame):
        return rows(running_sum(df, ["u"], "t", F.col("v"), "p", frame=frame, ties=["id"]), "id", "p")

    assert sums("range") == [(1, 3), (2, 3), (3, 1)]
    assert sums("rows") == [(1, 2), (2, 3), (3, 1)]


def test_mean_between_markers(spark):
    pages = ["NextSong", "NextSong", "Home", "NextSong", "Home", "Home", "NextSong", "NextSong", "NextSong", "Login"]
    df = inline_rows(spark, [(1, i, p) for i, p in enumerate(pages)], "u int, s int, page string")
    df = df.withColumn("t", F.timestamp_seconds("s"))
    page = F.col("page")
    mean = mean_between_markers(df, "u", "t", page == "NextSong", page == "Home").first()[0]
    assert mean == 2.0  # periods of 2, 1 and 3 songs; the empty one does not count


LOGS = [
    ("", "Home", None, None, None, 1, 0), ("", "Login", None, None, None, 2, 1),
    ("5", "NextSong", "F", "Muse", "Uprising", 3, 0), ("5", "Home", "F", None, None, 4, 1),
    ("5", "NextSong", "F", "Muse", "Starlight", 5, 2), ("6", "NextSong", "M", "Blur", "Song 2", 6, 0),
    ("7", "Settings", "F", None, None, 7, 0),
]


@pytest.fixture(scope="module")
def logs(spark):
    return inline_rows(
        spark, LOGS, "userId string, page string, gender string, artist string, song string, ts bigint, itemInSession bigint"
    )


def test_pages(logs):
    assert rows(questions.pages_not_visited(logs, "")) == [("NextSong",), ("Settings",)]
    assert rows(questions.pages_visited(logs, "")) == [("Home",), ("Login",)]


def test_user_questions(logs):
    assert questions.count_users(logs, "F").first()[0] == 2
    assert rows(questions.most_played_artist(logs)) == [("Muse", 2)]
    for frame in ("range", "rows"):
        assert questions.songs_between_home_visits(logs, frame).first()[0] == 1.0


def test_one_per_key_folds_before_shuffle(visits):
    plan = plan_text(one_per_key(visits.select("id", "user", "time"), ["user"], ["time", "id"]))
    assert plan.index("Exchange") < plan.index("partial_min")


@pytest.mark.parametrize("last", [False, True])
def test_one_per_key_equals_ranking_window(visits, last):
    order = [F.desc_nulls_last(c) if last else F.asc_nulls_last(c) for c in ("time", "page", "id")]
    rank = F.row_number().over(Window.partitionBy("user").orderBy(*order))
    want = visits.withColumn("r", rank).where("r = 1").drop("r")
    assert rows(one_per_key(visits, ["user"], ["time", "page", "id"], last)) == rows(want)


def test_one_per_key_of_other_shapes(spark):
    df = inline_rows(spark, [(1, 5, {"a": 1}), (1, 3, {"b": 2}), (None, 1, None)], "k int, n int, m map<string,int>")
    assert rows(one_per_key(df, ["k"], ["n"])) == [(1, 3, {"b": 2}), (None, 1, None)]
    assert rows(one_per_key(df, ["k"], [-F.col("n")])) == [(1, 5, {"a": 1}), (None, 1, None)]
    assert rows(one_per_key(df.select("k"), ["k"])) == [(1,), (None,)]


def test_nulls_do_not_win(spark):
    df = inline_rows(spark, [(1, None, "a"), (1, 5, "b"), (1, 7, None), (2, None, "c")], "k int, n int, s string")
    assert rows(one_per_key(df, ["k"], ["n"])) == [(1, 5, "b"), (2, None, "c")]
    assert rows(one_per_key(df, ["k"], ["n"], last=True)) == [(1, 7, None), (2, None, "c")]
    assert rows(dimension_rows(df, "k", ["s"], "first_sorted")) == [(1, "a"), (2, "c")]


def test_dimension_policies(spark):
    df = inline_rows(
        spark,
        [(1, "Ann", "paid", 1), (1, "Ann", "free", 2), (1, "Ann", "paid", 3), (2, "Bo", "free", 1), (None, "X", "free", 1)],
        "id int, name string, level string, ts int",
    )

    def users(policy):
        return rows(dimension_rows(df, "id", ["name", "level"], policy, ["ts"]))

    assert users("first") == [(1, "Ann", "paid"), (2, "Bo", "free")]
    assert users("latest") == [(1, "Ann", "paid"), (2, "Bo", "free")]
    assert users("first_sorted") == [(1, "Ann", "free"), (2, "Bo", "free")]
    assert users("distinct") == [(1, "Ann", "free"), (1, "Ann", "paid"), (2, "Bo", "free")]
    with pytest.raises(ValueError):
        users("other")
    with pytest.raises(ValueError):
        dimension_rows(df, "id", ["name"], "latest")


def test_last_write_wins(spark):
    df = inline_rows(spark, [("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, n int, v string")
    assert rows(last_write_wins(df, ["k"], ["n"]), "k", "v") == [("a", "y"), ("b", "z")]
