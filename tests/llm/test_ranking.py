"""Ranked search: every score against a plain computation, with and without skipping."""

import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm import ranking

RUN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [t.translate(LOWER) for t in RUN.findall(text or "")]


def brute(docs, queries, top):
    """(query, rank) to (id, score), from the definition alone."""
    split = [(key, words(text)) for key, text in docs]
    split = [(key, found) for key, found in split if found]
    n_documents, n_terms = len(split), sum(len(found) for _, found in split)
    frequency = {}
    for _, found in split:
        for term in set(found):
            frequency[term] = frequency.get(term, 0) + 1
    out = []
    for name, text in queries:
        scored = []
        for key, found in split:
            m = 100 - 50 + (50 * len(found) * n_documents) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_documents + 2) / (2 * frequency[t] + 1))) * ((1000000000 * found.count(t)) // (1000 * found.count(t) + 20 * m))
                for t in set(words(text)) & set(found)
            )
            if score > 0:
                scored.append((-score, key is None, key or 0))
        out += [(name, i + 1, None if null else key, -score) for i, (score, null, key) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def found_by(spark, docs, queries, top=50, partitions=3):
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id bigint, text string, item_id string, score int").repartition(partitions)
    asked = spark.createDataFrame([(k, t, 7) for k, t in queries], "item_id bigint, text string, doc_id int")
    return sorted((tuple(r) for r in ranking.search(frame, asked, top).collect()), key=repr)


@given(st.text(max_size=30))
def test_terms(text):
    assert [t.decode("utf-8", "surrogatepass") for t in ranking.terms(text)] == words(text)


ODD = [
    (1, "the cat SAT on the mat"), (2, "The cat"), (3, None), (4, ""), (5, "!?"), (6, "Éa cat-éa"), (7, "the cat"), (7, "the cat"),
    (None, "the cat"), (8, "mat " * 70_000), (9, "x\x00cat\x7fcat"), (2**63 - 1, "the cat"), (-3, "the cat"),
]


def test_odd_rows(spark):
    queries = [(1, "Cat the cat!"), (2, None), (3, ""), (4, "nowhere"), (None, "mat éa"), (1, "sat")]
    assert found_by(spark, ODD, queries) == brute(ODD, queries, 50)
    assert found_by(spark, ODD, queries, top=3) == brute(ODD, queries, 3)
    assert found_by(spark, [], queries) == [] and found_by(spark, ODD, []) == []
    assert found_by(spark, [(1, None), (2, "?")], queries) == []


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ranking.query_blocks, "__defaults__", (40,))
    queries = [(i, q) for i, q in enumerate(["cat", "the mat on", "sat " * 30, "éa"])]
    assert found_by(spark, ODD, queries) == brute(ODD, queries, 50)


@pytest.mark.parametrize("top", [1, 10])
def test_skipping_loses_nothing(spark, monkeypatch, top):
    """Many segments and blocks: common and rare terms, ties, long runs without a match."""
    monkeypatch.setattr(ranking, "SEGMENT_BYTES", 20_000)
    monkeypatch.setattr(ranking, "BLOCK", 4)
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(300)]
    share = 1 / np.arange(1, 301)
    docs = [(int(i), " ".join(rng.choice(vocabulary, size=rng.integers(1, 60), p=share / share.sum()))) for i in rng.permutation(3000)]
    docs += [(10_000 + i, docs[0][1]) for i in range(100)]
    queries = [(i, " ".join(rng.choice(vocabulary, size=8))) for i in range(10)] + [(10, "w0 w1 w2"), (11, docs[0][1])]
    assert found_by(spark, docs, queries, top, partitions=2) == brute(docs, queries, top)


LISTS = st.lists(st.lists(st.integers(0, 5), max_size=8), min_size=1, max_size=40)


@settings(max_examples=60, deadline=None)
@given(LISTS, st.lists(st.integers(0, 5), min_size=1, max_size=4), st.integers(1, 5))
def test_blocks_that_are_skipped_hold_nothing_better(texts, query, top):
    """The segment alone, with blocks of two documents and lists short or long."""
    old = ranking.BLOCK, ranking.SHORT
    ranking.BLOCK, ranking.SHORT = 2, 4
    try:
        docs = [(i, " ".join(f"w{t}" for t in text)) for i, text in enumerate(texts)]
        block = ranking.Block([(0, " ".join(f"w{t}" for t in query))])
        held, split = ranking.Documents(), [ranking.terms(text) for _, text in docs]
        for (key, _), found in zip(docs, split, strict=True):
            held.add(key, found, block.numbers)
        n, total = sum(map(bool, split)), sum(map(len, split))
        weights = np.array([ranking.weight(n, sum(t in found for found in split)) for t in block.numbers])
        best = ranking.Best(top)
        if held.ids:
            ranking.Segment(held, weights, n, total).search(block.queries[0][1], best)
        want = brute(docs, [(0, " ".join(f"w{t}" for t in query))], top)
        order = sorted(zip((-best.scores).tolist(), best.ids.tolist(), strict=True))
        assert [(k, -s) for s, k in order] == [(k, s) for _, _, k, s in sorted(want, key=lambda r: r[1])]
    finally:
        ranking.BLOCK, ranking.SHORT = old
