from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeloom.session import scratch_path
from lakeloom.sources.tables import inline_rows
from lakeloom.streaming import eventtime
from lakeloom.streaming.eventtime import load_in_event_time

START = datetime(2024, 1, 1)


@pytest.fixture
def paths(spark):
    return {n: scratch_path(spark, n) for n in ("landing", "target", "late", "state")}


def delivery(spark, *data):
    """Rows of (id, hours after the start or None)."""
    typed = [(i, None if h is None else START + timedelta(hours=h)) for i, h in data]
    return inline_rows(spark, typed, "id bigint, time timestamp")


def load(spark, paths, schema, **options):
    accepted, late = load_in_event_time(
        spark, paths["landing"], schema, paths["target"], paths["late"], paths["state"], ["id"], "time", timedelta(hours=10), **options
    )
    return rows(accepted, "id"), rows(late, "id", "reason")


def test_copies_and_late_rows_over_three_deliveries(spark, paths):
    first = delivery(spark, (1, 0), (2, 20), (2, 20), (9, None))
    first.write.parquet(f"{paths['landing']}/1")
    assert load(spark, paths, first.schema) == ([(1,), (2,)], [(9, "no time")])
    # The watermark is at hour 10: a copy of 2 is folded, a copy of 1 is late, 3 is late
    # although no one has seen it, 4 is in time.
    delivery(spark, (2, 20), (1, 0), (3, 10), (4, 10.001), (5, 40)).write.parquet(f"{paths['landing']}/2")
    late = [(1, "late"), (3, "late"), (9, "no time")]
    assert load(spark, paths, first.schema) == ([(1,), (2,), (4,), (5,)], late)
    delivery(spark, (5, 40), (6, 31), (7, 30), (6, 31)).write.parquet(f"{paths['landing']}/3")
    late = sorted([*late, (7, "late")], key=repr)
    assert load(spark, paths, first.schema) == ([(1,), (2,), (4,), (5,), (6,)], late)
    # A call that finds nothing changes nothing.
    assert load(spark, paths, first.schema) == ([(1,), (2,), (4,), (5,), (6,)], late)


@pytest.mark.parametrize("broken", ["_sorted_out", "between"])
def test_restart_from_the_checkpoint(spark, paths, monkeypatch, broken):
    """A call that breaks, within a delivery or between the streams, is finished by the next."""
    first = delivery(spark, (1, 0), (2, 20))
    first.write.parquet(f"{paths['landing']}/1")
    load(spark, paths, first.schema)
    delivery(spark, (1, 0), (2, 20), (3, 15), (4, 50)).write.parquet(f"{paths['landing']}/2")
    with monkeypatch.context() as patch:
        if broken == "between":
            patch.setattr(eventtime.F, "to_date", None)  # the second stream cannot start
        else:
            write, done = eventtime.write_parquet, []

            def failing(df, path, mode):
                done.append(path)
                if len(done) == 3:
                    raise RuntimeError("lost")
                write(df, path, mode)

            patch.setattr(eventtime, "write_parquet", failing)
        with pytest.raises(Exception):
            load(spark, paths, first.schema)
    delivery(spark, (5, 41), (6, 40)).write.parquet(f"{paths['landing']}/3")
    assert load(spark, paths, first.schema, files_per_batch=1000)[0][:4] == [(1,), (2,), (3,), (4,)]
    accepted, late = load(spark, paths, first.schema)
    assert accepted[:4] == [(1,), (2,), (3,), (4,)] and (1, "late") in late
    assert len(accepted) + len(late) == 7


def test_state_is_emptied(spark, paths):
    """The state holds the keys of the last delay only, however many deliveries went before."""
    schema = delivery(spark).schema
    for n in range(4):
        delivery(spark, *[(100 * n + i, 30 * n + i / 10) for i in range(50)]).write.parquet(f"{paths['landing']}/{n}")
        load(spark, paths, schema)
    state = spark.read.format("statestore").load(f"{paths['state']}/folding")
    assert 50 <= state.count() <= 100
    assert spark.read.parquet(paths["target"]).select(F.countDistinct("id")).first()[0] == 200
