"""Quality: measures against a plain form, learning from votes, edge cases."""

import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    covered = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x1c\x85 é#|日", max_size=200) | st.text(max_size=60))
def test_measures_equal_plain_form(text):
    assert quality.measure_text(text)[:5] == plain_measures(text)


def test_windows_that_overlap():
    assert quality.repeated_words([b"a"] * 9) == 9
    assert quality.repeated_words([b"a"] * 8) == 0
    words = [b"%d" % i for i in range(8)]
    assert quality.repeated_words(words + [b"x"] + words) == 16


def good_text(rng, n=80):
    return " ".join(rng.choice("river stone light morning people walk across old bridge toward market".split()) + ("." if i % 11 == 10 else "") for i in range(n)) + "."


def test_faults_are_found_and_good_texts_kept(spark):
    rng = random.Random(1)
    words = lambda n: ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(n)]
    rows, want = [], {}
    for i in range(300):
        kind = ("good", "good", "good", "symbols", "loud", "table")[i % 6]
        w = words(90)
        text = {
            "good": " ".join(x + ("." if k % 9 == 8 else "") for k, x in enumerate(w)),
            "symbols": " ".join(x + "***" for x in w),
            "loud": " ".join(x.upper() + "!!" for x in w),
            "table": " | ".join(w),
        }[kind]
        rows.append((i, text))
        want[i] = kind == "good"
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    measured = quality.measure(docs, ["doc_id"]).cache()
    assert {r.doc_id: r.kept for r in quality.judged(measured, quality.learn(measured)).collect()} == want


def test_nulls_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, None, "q"), (1, "", "q"), (2, "x" * 100_000, "q"), (2, "x" * 100_000, "q")], "doc_id bigint, text string, quality string")
    measured = quality.measure(docs, ["doc_id"])
    rows = quality.judged(measured, quality.learn(measured)).collect()
    assert len(rows) == 4 and all(r.base_failed and not r.kept for r in rows)
    empty = quality.measure(docs.limit(0), ["doc_id"])
    assert quality.judged(empty, quality.learn(empty)).collect() == []


def test_query_against_labels(spark, tables):
    from lakeloom.llm.queries import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op4_quality"](spark, tables.root).collect()}
    texts = {r.doc_id: r.text or "" for r in tables.documents.collect()}
    assert rows.keys() == texts.keys()
    for key, r in rows.items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_measures(texts[key])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    labels = [r for r in tables.labels.collect() if r.doc_id in rows and not rows[r.doc_id].base_failed]
    right = sum(rows[r.doc_id].kept == (r.quality == 1) for r in labels)
    assert right >= 0.97 * len(labels)
