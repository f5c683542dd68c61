"""Jaccard join: signatures lose no link, components equal brute force, edge cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from lakeloom.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text, words=5):
    found = WORD.findall((text or "").translate(LOWER))
    if not found:
        return frozenset()
    width = min(words, len(found))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def brute(texts, words=5, percent=80):
    """Component of every document by comparing all pairs that share an element."""
    sets = {k: plain_set(t, words) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, s in sets.items():
        for e in s:
            holders[e].append(k)
    for a, s in sets.items():
        for b, common in Counter(k for e in s for k in holders[e]).items():
            if a < b and 100 * common >= percent * (len(s) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: (len(sets[k]), find(k)) for k in texts}


WORDS_AND_GAPS = st.lists(st.sampled_from(["a", "B", "ab", "é", "\x85", "日本", " ", "\t\n", "\x00", "aaaaaaaaaaaaaaaaaaaaaaa"]), max_size=40)


@given(WORDS_AND_GAPS, WORDS_AND_GAPS, st.sampled_from([3, 8, 1 << 18]))
def test_shingles_are_equal_where_words_are(one, two, piece):
    """Whatever the pieces in which a text is hashed."""
    old = jaccard._PIECE
    try:
        jaccard._PIECE = piece
        found = [jaccard.shingles("".join(x)) for x in (one, two)]
    finally:
        jaccard._PIECE = old
    sets = [plain_set("".join(x)) for x in (one, two)]
    assert [len(f) for f in found] == [len(x) for x in sets]
    assert len(np.intersect1d(*found)) == len(sets[0] & sets[1])
    assert all((f[1:] > f[:-1]).all() for f in found)


def chosen(elements, percent=80):
    """Signatures of a set after the choice, sizes of groups being any function of a signature."""
    sig, band, spare = jaccard.signatures(elements, percent)
    out = []
    for b in np.unique(band):
        own = sig[band == b]
        size = (own // np.uint64(7)) % np.uint64(5) + np.uint64(1)
        needed = len(own) - max(int(spare[band == b][0]), 0)
        out += own[size <= np.sort(size)[needed - 1]].tolist()
    return out


@pytest.mark.parametrize("percent", [80, 90, 60])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for _ in range(1500):
        n = int(rng.integers(1, rng.choice([6, 12, 60, 900])))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        most = (100 - percent) * len(a) * 2 // (100 + percent)
        gone = int(rng.integers(0, most + 1))
        kept = a[rng.permutation(len(a))[gone:]]
        b = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, int(rng.integers(0, most - gone + 1)), dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= percent * (len(a) + len(b) - common):
            assert set(chosen(a, percent)) & set(chosen(b, percent)), (a, b)
            differ = int(np.bitwise_count((jaccard._parity(a) ^ jaccard._parity(b)).view(np.uint64)).sum())
            assert differ <= len(a) + len(b) - 2 * common


def test_crowded_small_sets_share_a_signature():
    # All elements in one part: the set gives a signature for each element as well.
    base = (np.arange(1, 9, dtype=np.uint64) << np.uint64(20)) * np.uint64(12)
    assert set(chosen(base)) & set(chosen(base[1:]))


@pytest.mark.parametrize("seed", range(3))
def test_pairs_of_arrays_equal_a_double_loop(seed):
    rng = np.random.default_rng(seed)
    size = 300
    n, comp, side = rng.integers(1, 60, size), rng.integers(0, 20, size), rng.integers(0, 3, size)
    parity = rng.integers(0, 4, (size, 3)) ^ np.array([0, -1, 0])[rng.integers(0, 3, (size, 1))]
    want = set()
    for i in range(size):
        for j in range(i):
            near = min(n[i], n[j]) * 100 >= max(n[i], n[j]) * 80
            differ = sum(int(x).bit_count() for x in (parity[i] ^ parity[j]).view(np.uint64))
            if near and comp[i] != comp[j] and (side[i] != side[j] or side[i] == 0) and differ * 180 <= (n[i] + n[j]) * 20:
                want.add((j, i))
    # Many small groups at once find what each finds alone.
    starts = np.array([0, 1, 1, 40, 41, 120, 300])
    alone = set()
    for first, last in zip(starts, starts[1:], strict=False):
        a, b = jaccard.near_pairs(n[first:last], comp[first:last], parity[first:last], np.zeros(last - first, dtype=int), 80)
        alone |= set(zip((np.minimum(a, b) + first).tolist(), (np.maximum(a, b) + first).tolist(), strict=True))
    a, b = jaccard.near_pairs_of_groups(starts, n, comp, parity, 80)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == alone and len(a) == len(alone) > 0
    a, b = jaccard.near_pairs(n, comp, parity, side, 80)
    assert sorted(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True)) == sorted(want) and want


def family(seed, size, words=60):
    """Near copies of one text, on both sides of the threshold, and a passage that all share."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    texts = {i: " ".join(edited(rng, base, rng.randrange(5))) for i in range(size)}
    passage = " ".join(f"shared{i}" for i in range(30))
    return texts | {1000 + i: passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) for i in range(size)}


@pytest.mark.parametrize("block", [7, 8192])
def test_a_family_across_the_threshold_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "_BLOCK", block)
    texts = family(block, 60)
    want = brute(texts)
    assert len({c for _, c in want.values()}) > 61
    rows = jaccard.similar_groups(frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want


@pytest.mark.parametrize("block", [7, 8192])
def test_pairs_of_many_signatures_become_few_rows(spark, monkeypatch, block):
    """Sets that meet in many signatures: a forest comes out first, then each pair about once."""
    monkeypatch.setattr(jaccard, "_BLOCK", block)
    size, groups = 40, 30
    data = [(sig, size, 1, 0, k, 100, k, [k % 3]) for sig in range(groups) for k in range(1, size + 1)]
    rows = spark.createDataFrame(data, "sig bigint, members bigint, least bigint, share bigint, k1 bigint, n bigint, comp bigint, parity array<bigint>")
    pairs = {(a, b) for a in range(1, size + 1) for b in range(a + 1, size + 1)}
    found = jaccard._pairs_across(rows, 80, True).collect()
    first = [(r.x, r.y) for r in found if r.sig is None]
    blocks = -(-size // block)
    assert set(first) <= pairs and size - 1 <= len(first) <= (size - 1) * blocks**2
    assert all(r.x is None for r in found if r.sig is not None) and {r.sig for r in found} & set(range(groups))
    every = [(r.x, r.y) for r in jaccard._pairs_across(rows, 80, False).collect()]
    assert set(every) == pairs and len(every) == len(pairs)


def test_a_forest_takes_the_nearest_pairs():
    a, b = np.array([1, 1, 2, 5, 2]), np.array([2, 3, 3, 6, 1])
    assert jaccard.forest(a, b, np.array([0.3, 0.1, 0.2, 0.9, 0.4])).tolist() == [False, True, True, True, False]


def test_shared_passages_meet_in_no_pair(spark):
    """Texts that share a passage have enough rare signatures to do without those of the passage."""
    rng = random.Random(3)
    passage = " ".join(f"shared{i}" for i in range(25))
    texts = {i: passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(80)) for i in range(80)}
    rows = jaccard._signature_rows(frame(spark, texts).select("text"), 5, 80, "text")
    together = rows.groupBy("sig").count().where("count > 1").agg({"count": "sum"}).first()[0]
    assert jaccard._chosen(rows).count() * 5 <= together


def test_one_id_with_different_texts(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "q r s t u v"), (2, "Q R s t u v"), (3, "a b c d e f")], "doc_id bigint, text string")
    rows = sorted((r.doc_id, r.component_id) for r in jaccard.similar_groups(docs).collect())
    assert rows == [(1, 1), (1, 1), (2, 1), (3, 1)]
    long = [f"w{i}" for i in range(80)]
    near = edited(random.Random(1), long, 1)
    docs = spark.createDataFrame([(5, " ".join(long)), (5, "other words stand here instead"), (4, " ".join(near)), (6, "none")], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.component_id) for r in jaccard.similar_groups(docs).collect()) == [(4, 4), (5, 4), (5, 5), (6, 6)]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def corpus(seed):
    rng = random.Random(seed)
    texts = {}
    passage = [f"shared{i}" for i in range(40)]
    for _ in range(25):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 5, 8, 30, 120, 400]))]
        if rng.random() < 0.4:
            words[:0] = passage
        for _ in range(rng.choice([1, 2, 6])):
            copy = edited(rng, words, rng.choice([0, 0, 1, 2, len(words) // 60, len(words) // 25]))
            texts[len(texts)] = "  ".join(copy).replace("w", rng.choice("wW")) + rng.choice(["", " ", "\n"])
    return texts


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    texts = corpus(seed) | {900: None, 901: "", 902: " \n", 903: "\x85", 904: "\x85"}
    rows = jaccard.similar_groups(frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts)


def test_chain_of_near_copies(spark):
    words = [f"w{i}" for i in range(100)]
    texts = {}
    for i in range(12):
        texts[11 - i] = " ".join(words)
        words[i * 8] = f"x{i}"
    want = brute(texts)
    assert len(set(want.values())) < 12
    rows = jaccard.similar_groups(frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want


def test_empty_table_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(3, "a b c", 1), (3, "a b c", 1), (2, "A B C", 2), (None, "a b c", 3), (None, None, 4)], "doc_id bigint, text string, n int")
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs).collect()), key=str)
    assert rows == sorted([(3, 1, 2), (3, 1, 2), (2, 1, 2), (None, 1, 2), (None, 0, None)], key=str)
    assert jaccard.similar_groups(docs.limit(0)).collect() == []


def test_query_over_small_tables(spark, tables):
    from lakeloom.llm.queries import QUERIES

    rows = QUERIES["op10_jaccard"](spark, tables.root).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute({r.doc_id: r.text for r in tables.documents.collect()})
