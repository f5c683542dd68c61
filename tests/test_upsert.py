import random

import pytest
from conftest import rows

from lakeloom.operators.upsert import insert_ignore, upsert
from lakeloom.session import scratch_path
from lakeloom.sinks.files import write_partitioned
from lakeloom.sinks.folders import DONE, SIDE, apply_upsert, finish_replacement
from lakeloom.sources.tables import inline_rows

USERS = "user_id int, name string, level string, n int"


def test_insert_ignore(spark):
    target = inline_rows(spark, [(1, "Ann", "free", 0), (2, "Bo", "paid", 0)], USERS)
    batch = inline_rows(spark, [(2, "Bob", "free", 1), (3, "Cy", "free", 2), (3, "Cyd", "paid", 3)], USERS)
    once = insert_ignore(target, batch, ["user_id"], ["n"])
    assert rows(once, "user_id", "name") == [(1, "Ann"), (2, "Bo"), (3, "Cy")]
    assert rows(insert_ignore(once, batch, ["user_id"], ["n"])) == rows(once)


def test_upsert(spark):
    target = inline_rows(spark, [(1, "Ann", "free"), (2, "Bo", "paid")], "user_id int, name string, level string")
    batch = inline_rows(spark, [(2, "Bob", "free", 1), (2, "Rob", None, 2), (3, "Cy", "free", 3)], USERS)
    once = upsert(target, batch, ["user_id"], ["level"], ["n"])
    assert rows(once) == [(1, "Ann", "free"), (2, "Bo", None), (3, "Cy", "free")]
    assert rows(upsert(once, batch, ["user_id"], ["level"], ["n"])) == rows(once)


def test_against_row_by_row_inserts(spark):
    """Random batches against a dictionary that takes one row at a time."""
    rng = random.Random(3)
    data = [[(rng.randrange(30), f"n{i}", rng.choice(["free", "paid"]), i) for i in range(60 * b, 60 * b + 60)] for b in range(3)]
    kept: dict = {}
    updated: dict = {}
    target = inline_rows(spark, [], "user_id int, name string, level string, n int")
    ignoring, updating = target, target
    for batch in data:
        for user, name, level, n in batch:
            kept.setdefault(user, (name, level, n))
        last = {row[0]: row for row in batch}
        for user, (_, name, level, n) in last.items():
            updated[user] = (updated[user][0], level, updated[user][2]) if user in updated else (name, level, n)
        df = inline_rows(spark, batch, USERS)
        ignoring = insert_ignore(ignoring, df, ["user_id"], ["n"])
        updating = upsert(updating, df, ["user_id"], ["level"], ["n"])
    assert {r[0]: tuple(r[1:]) for r in ignoring.collect()} == kept
    assert {r[0]: tuple(r[1:]) for r in updating.collect()} == updated


def test_stored_upsert_survives_a_break(spark):
    target = scratch_path(spark, "stored")
    first = inline_rows(spark, [("a", 1, "x"), ("b", 2, "x"), ("c", 3, "x")], "part string, id int, v string")
    write_partitioned(first, target, ["part"])
    batch = inline_rows(spark, [("a", 1, "y"), ("a", 9, "y"), ("d", 4, "y")], "part string, id int, v string")

    def stored():
        return rows(spark.read.schema(first.schema).parquet(target), "part", "id", "v")

    for _ in range(2):
        apply_upsert(target, batch, ["part", "id"], "part")
        assert stored() == [("a", 1, "x"), ("a", 9, "y"), ("b", 2, "x"), ("c", 3, "x"), ("d", 4, "y")]
    # Written whole at the side, not moved in: the next run moves it. Not written whole: dropped.
    write_partitioned(inline_rows(spark, [("b", 2, "z")], "part string, id int, v string"), f"{target}/{SIDE}", ["part"])
    finish_replacement(spark, target)
    assert ("b", 2, "x") in stored()
    write_partitioned(inline_rows(spark, [("b", 2, "z")], "part string, id int, v string"), f"{target}/{SIDE}", ["part"])
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{SIDE}/{DONE}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()
    apply_upsert(target, batch, ["part", "id"], "part", update=["v"])
    assert stored() == [("a", 1, "y"), ("a", 9, "y"), ("b", 2, "z"), ("c", 3, "x"), ("d", 4, "y")]
    with pytest.raises(ValueError):
        apply_upsert(target, batch, ["id"], "part")
