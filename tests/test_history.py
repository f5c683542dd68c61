"""Dimension history and keys that last, against row-by-row forms."""

import random
from datetime import date, timedelta

import pytest
from conftest import rows

from lakeloom.operators.history import as_of_day, first_history, merge_history
from lakeloom.operators.numbering import lasting_keys
from lakeloom.sources.tables import inline_rows

DAY = date(2024, 1, 1)
SCHEMA = "id int, name string, level string"


def plain(history, batch, day, whole):
    """The rules, one row at a time."""
    out = [r for r in history if r[4] is not None]
    still_open = {r[0]: r for r in history if r[4] is None}
    new = {}
    for r in sorted((r for r in batch if r[0] is not None), key=lambda r: tuple((x is not None, x or "") for x in r[1:]), reverse=True):
        new[r[0]] = r
    for key in still_open.keys() | new.keys():
        old, told = still_open.get(key), new.get(key)
        if told is None:
            if whole and old[3] != day:
                out.append((*old[:4], day))
            elif not whole:
                out.append(old)
        elif old is None:
            out.append((*told, day, None))
        elif old[:3] == told:
            out.append(old)
        else:
            if old[3] != day:
                out.append((*old[:4], day))
            out.append((*told, day, None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("whole", [True, False])
def test_random_batches(spark, whole):
    rng = random.Random(7 + whole)

    def batch():
        return [(rng.choice([None, *range(12)]), rng.choice(["Ann", "Bo", None]), rng.choice(["free", "paid"])) for _ in range(10)]

    first = batch()
    history = first_history(inline_rows(spark, first, SCHEMA), "id", ["name", "level"], DAY)
    want = plain([], first, DAY, False)
    assert rows(history) == want
    for n in (1, 1, 3):
        day, data = DAY + timedelta(days=n), batch()
        for _ in range(2):
            history = merge_history(inline_rows(spark, rows(history), history.schema), inline_rows(spark, data, SCHEMA), "id", ["name", "level"], day, whole)
            assert rows(history) == plain(want, data, day, whole)
        want = plain(want, data, day, whole)
    by_key = {}
    for r in sorted(want, key=lambda r: (r[0], r[3])):
        by_key.setdefault(r[0], []).append(r)
    for found in by_key.values():
        assert sum(r[4] is None for r in found) <= 1
        assert all(a[4] is not None and a[4] <= b[3] and (whole or a[4] == b[3]) for a, b in zip(found, found[1:], strict=False))
    assert rows(as_of_day(history, DAY)) == sorted([r for r in want if r[3] == DAY and (r[4] is None or r[4] > DAY)], key=repr)


def test_older_batches_are_refused(spark):
    history = first_history(inline_rows(spark, [(1, "a", "b"), (2, "a", "b")], SCHEMA), "id", ["name", "level"], DAY)
    with pytest.raises(Exception, match="open since"):
        merge_history(history, inline_rows(spark, [(1, "x", "b")], SCHEMA), "id", ["name", "level"], DAY - timedelta(days=1)).collect()
    assert rows(merge_history(history, inline_rows(spark, [], SCHEMA), "id", ["name", "level"], DAY)) == rows(history)


def test_lasting_keys(spark):
    rng = random.Random(2)
    known, want = None, {}
    for _ in range(4):
        data = [(rng.choice([None, *range(30)]), rng.choice(["a", "b", None])) for _ in range(25)]
        fresh = sorted({d for d in data if d not in want}, key=lambda d: ((d[0] is not None, d[0] or 0), (d[1] is not None, d[1] or "")))
        for d in fresh:
            want[d] = len(want) + 1
        for _ in range(2):
            known = lasting_keys(inline_rows(spark, data, "k int, s string"), known, ["k", "s"], "key")
            known = inline_rows(spark, rows(known), known.schema)
            assert {(r.k, r.s): r.key for r in known.collect()} == want
    assert rows(lasting_keys(inline_rows(spark, [], "k int"), None, ["k"], "key")) == []
    assert rows(lasting_keys(inline_rows(spark, [(5,)], "k int"), None, ["k"], "key", first=10)) == [(5, 10)]
