"""Sharding: sizes even, slots without gaps, groups together, edge cases."""

import zlib
from collections import Counter, defaultdict

import pytest

from lakeloom.llm import sharding


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    filled = Counter(r.shard for r in rows)
    sizes = [filled.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(filled) <= set(range(shards))
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    by_id = defaultdict(list)
    for key, text in texts:
        data = (text or "").encode()
        by_id[key].append((len(data) + 16, zlib.crc32(data)))
    for r in rows:
        assert (r.size, r.text_crc32) in by_id[r.doc_id]


def cut_groups(rows, texts):
    """Groups of equal texts, and how many of them lie in more than one shard."""
    text_of = dict(texts)
    places = defaultdict(list)
    for r in rows:
        places[text_of[r.doc_id] or ""].append(r.shard)
    groups = [p for p in places.values() if len(p) > 1]
    return len(groups), sum(len(set(p)) > 1 for p in groups)


@pytest.mark.parametrize("windows", [20_000, 3])
def test_groups_stay_together(spark, windows, monkeypatch):
    monkeypatch.setattr(sharding, "_WINDOW_ROWS", windows)
    texts = [(i, f"single {i}") for i in range(400)] + [(1000 + i, f"pair {i // 2}") for i in range(160)] + [(2000 + i, f"nine {i // 9}") for i in range(45)]
    docs = spark.createDataFrame([(k, t, 0, 0) for k, t in texts], "doc_id bigint, text string, shard int, label int")
    rows = sharding.balanced_shards(docs, shards=7).collect()
    check(rows, texts, 7)
    groups, cut = cut_groups(rows, texts)
    assert groups == 85 and cut <= 4


def test_a_group_of_a_third_of_all_rows_is_split(spark):
    texts = [(i, f"single {i}") for i in range(200)] + [(1000 + i, "hot") for i in range(150)] + [(2000 + i, f"pair {i // 2}") for i in range(40)]
    rows = sharding.balanced_shards(spark.createDataFrame(texts, "doc_id bigint, text string"), shards=10).collect()
    check(rows, texts, 10)
    groups, cut = cut_groups(rows, texts)
    assert groups == 21 and cut <= 4
    only = [(i, "hot") for i in range(23)]
    check(sharding.balanced_shards(spark.createDataFrame(only, "doc_id bigint, text string"), shards=10).collect(), only, 10)


@pytest.mark.parametrize("large_part", [50, 1])
def test_only_groups_that_fit_nowhere_are_cut(spark, monkeypatch, large_part):
    # With 1, all groups that fit a quota are placed in rounds, few rows to a window.
    monkeypatch.setattr(sharding, "_LARGE_PART", large_part)
    monkeypatch.setattr(sharding, "_WINDOW_ROWS", 20_000 if large_part > 1 else 7)
    texts = [(i, f"single {i}") for i in range(500)] + [(10_000 + i, "hot") for i in range(600)]
    texts += [(20_000 + i, f"pair {i // 2}") for i in range(500)] + [(30_000 + i, f"nine {i // 9}") for i in range(180)]
    rows = sharding.balanced_shards(spark.createDataFrame(texts, "doc_id bigint, text string"), shards=40).collect()
    check(rows, texts, 40)
    groups, cut = cut_groups(rows, texts)
    hot = len({r.shard for r in rows if r.doc_id // 10_000 == 1})
    print(f"cut {cut} of {groups}, hot in {hot}")
    assert groups == 271 and cut == 1
    assert hot <= 24  # 14 quotas; small groups have a third of each


def test_tight_quotas_and_equal_rows_of_a_cut_group(spark, monkeypatch):
    monkeypatch.setattr(sharding, "_LARGE_PART", 1)
    # No loose rows: 25 places in each of 8 shards hold 12 pairs and one row of a cut pair.
    texts = [(i, f"pair {i // 2}") for i in range(200)]
    rows = sharding.balanced_shards(spark.createDataFrame(texts, "doc_id bigint, text string"), shards=8).collect()
    check(rows, texts, 8)
    assert cut_groups(rows, texts) == (100, 4)
    same = [(7, "hot")] * 50 + [(100 + i, f"pair {i // 2}") for i in range(40)] + [(500 + i, f"single {i}") for i in range(10)]
    rows = sharding.balanced_shards(spark.createDataFrame(same, "doc_id bigint, text string"), shards=5).collect()
    check(rows, same, 5)
    assert cut_groups(rows, same)[1] == 1


def test_nulls_repeated_rows_and_empty_table(spark):
    texts = [(None, None), (1, ""), (1, ""), (1, None), (2, "é" * 50_000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    check(sharding.balanced_shards(docs, shards=3).collect(), texts, 3)
    assert sharding.balanced_shards(docs.limit(0), shards=3).collect() == []


def test_query_over_small_tables(spark, tables):
    from lakeloom.llm.queries import QUERIES

    texts = [(r.doc_id, r.text) for r in tables.documents.collect()]
    rows = QUERIES["op6_sharding"](spark, tables.root).collect()
    check(rows, texts, 40)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    groups, cut = cut_groups(rows, texts)
    assert cut <= 0.25 * groups
