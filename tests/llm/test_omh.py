"""Order MinHash: tuples against a plain form, neighbours, likeness, edge cases."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import omh


def edited(texts):
    """Expected lengths and edited texts by id, of pairs sorted by id."""
    out = {}
    for i, (key, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1] or ""
        text = text or ""
        half = len(text) // 2
        out[key] = (len(text), text[: len(text) - half] + following[:half])
    return out


def check(rows, texts):
    want = edited(texts)
    assert len(rows) == len(texts)
    for r in rows:
        n, text = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(text.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def some_texts(n, seed=3):
    rng = random.Random(seed)
    return [(i * 3, " ".join(rng.choice(("al", "be", "ga", "日本", "x")) + str(rng.randrange(300)) for _ in range(rng.choice((0, 1, 2, 30, 200))))) for i in range(n)]


@pytest.mark.parametrize("rows_of_a_range", [1500, 4, 1])
def test_neighbours_over_ranges(spark, monkeypatch, rows_of_a_range):
    monkeypatch.setattr(omh, "_RANGE_ROWS", rows_of_a_range)
    texts = some_texts(60)
    docs = spark.createDataFrame([(k, t, "c", 0) for k, t in reversed(texts)], "doc_id bigint, text string, own string, _at int").repartition(5)
    rows = omh.compare_with_edit(docs).collect()
    check(rows, texts)
    by_id = {r.doc_id: r for r in rows}
    for (a, _), (b, _) in zip(texts, texts[1:] + texts[:1], strict=True):
        if by_id[a].fingerprint == by_id[b].fingerprint:
            assert by_id[a].near_next == 1


def hashes(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.t for r in frame.select("i", omh.tuples(F.col("text")).alias("t")).orderBy("i").collect()]


def alike(a, b):
    bins = {x >> 57 for x in a} | {x >> 57 for x in b}
    return len(set(a) & set(b)) / len(bins) if bins else 1.0


def test_order_and_occurrence_matter(spark):
    words = [f"w{i}" for i in range(300)]
    other = words[150:] + words[:150]
    mixed = random.Random(5).sample(words, len(words))
    texts = [" ".join(words), "\n".join(words) + " ", " ".join(other), " ".join(words + words), " ".join(mixed), "", None, " \t"]
    base, same, turned, twice, shuffled, empty, none, blank = hashes(spark, texts)
    assert base == same == sorted(base) and empty == none == blank == []
    assert 0.2 < alike(base, turned) < 0.9  # the same k-mers but one, in another order
    assert 0.05 < alike(base, twice) < 0.9
    assert alike(base, shuffled) < 0.1


def plain_omh(one, other, rounds=200):
    """Share of permutations in which the two least k-mers of all, in text order, are equal."""

    def sketch(text, salt):
        grams = [f"{a} {b}" for a, b in zip(text.split(), text.split()[1:], strict=False)]
        numbered = [(hashlib.md5(f"{salt} {g} {grams[:i].count(g)}".encode()).digest(), i, g) for i, g in enumerate(grams)]
        return [g for _, _, g in sorted(sorted(numbered)[:2], key=lambda x: x[1])]

    return sum(sketch(one, s) == sketch(other, s) for s in range(rounds)) / rounds


@pytest.mark.parametrize("n", [20, 50, 77, 100])
def test_short_texts_keep_their_order(spark, n):
    rng = random.Random(n)
    pairs = []
    for t in range(30):
        words = [f"t{t}w{i}" for i in range(n)]
        sentences = [words[i : i + n // 5] for i in range(0, n, n // 5)]
        rng.shuffle(sentences)
        pairs.append((" ".join(words), " ".join(w for s in sentences for w in s)))
    found = hashes(spark, [x for pair in pairs for x in pair])
    got = sum(alike(a, b) for a, b in zip(found[::2], found[1::2], strict=True)) / len(pairs)
    want = sum(plain_omh(*pair) for pair in pairs) / len(pairs)
    print(f"{n} words: {got:.3f}, plain {want:.3f}")
    assert abs(got - want) < 0.06


def test_occurrences_number_repeated_kmers(spark):
    # Copies of one k-mer differ by their number, so how many there are is told apart.
    three, four, many, more = hashes(spark, ["a " * 4, "a " * 5, "a " * 1000, "a " * 1001])
    assert len(three) <= 3 < len(many)
    assert three != four
    assert alike(many, more) > 0.9


def plain(text):
    """Bins of a text's numbered k-mers, by the package's hash of each k-mer."""
    found = text.split()
    grams = [tuple(found[i : i + omh.K]) for i in range(max(1, len(found) - omh.K + 1))]
    return {(g, grams[:i].count(g)) for i, g in enumerate(grams)}


def test_likeness_follows_numbered_kmers(spark):
    rng = random.Random(8)
    base = [rng.choice("abcdefgh") for _ in range(400)]
    near = base[:200] + ["z"] + base[200:]
    far = base[:60] + [rng.choice("ijkl") for _ in range(340)]
    a, b, c = hashes(spark, [" ".join(x) for x in (base, near, far)])
    shared = lambda x, y: len(plain(" ".join(x)) & plain(" ".join(y)))
    assert shared(base, near) > shared(base, far)
    assert alike(a, b) > 0.7 > 0.3 > alike(a, c)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, "n"), (1, None), (2, "é日" * 30_000), (3, "a b c")], "doc_id bigint, text string")
    check(omh.compare_with_edit(docs).collect(), [(None, "n"), (1, None), (2, "é日" * 30_000), (3, "a b c")])
    check(omh.compare_with_edit(docs.where("doc_id = 3")).collect(), [(3, "a b c")])
    assert omh.compare_with_edit(docs.limit(0)).collect() == []
    twice = omh.compare_with_edit(docs.where("doc_id = 3").union(docs.where("doc_id = 3"))).collect()
    assert len(twice) == 2 and all(r.near_next == 1 for r in twice)
    assert omh.fingerprints(docs).where("doc_id = 1").first().fingerprint == ""


def test_texts_without_spaces(spark):
    rng = random.Random(6)
    base = "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(3000))
    other = "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(3000))
    coded = "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(3000))
    texts = [base, base[:900] + "z" + base[901:], base[:900] + base[901:], base[1500:] + base[:1500], other, coded, coded[:50] + "x" + coded[50:]]
    one, changed, shorter, turned, far, data, longer = hashes(spark, texts)
    print(alike(one, changed), alike(one, shorter), alike(one, turned), alike(data, longer))
    assert min(alike(one, changed), alike(one, shorter), alike(data, longer)) > 0.9
    assert 0.2 < alike(one, turned) < 0.9 and alike(one, far) == 0
    # One long word does not hide the words around it, nor words the change in it.
    around = " ".join(f"w{i}" for i in range(200))
    with_long, without = hashes(spark, [f"{around} {coded[:60]}", around])
    assert 0.3 < alike(with_long, without) < 1
    # Four-byte characters beyond the length, and a length just within it.
    assert hashes(spark, ["😀" * 12, "😀" * 13])[0] != hashes(spark, ["😀" * 13])[0]


def test_query_over_small_tables(spark, tables):
    from lakeloom.llm.queries import QUERIES

    texts = sorted((r.doc_id, r.text) for r in tables.documents.collect())
    rows = QUERIES["op8_fingerprints"](spark, tables.root).collect()
    check(rows, texts)
    of_text = {}
    for r in rows:
        assert of_text.setdefault(dict(texts)[r.doc_id], r.fingerprint) == r.fingerprint
    near = sorted(r.near_edited - r.near_next for r in rows)
    assert near[len(near) // 20] > 0
