"""Toxicity: folding, lexicon, exceptions, held-out labels, edge cases."""

import pathlib
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm import toxicity
from lakeloom.llm.toxicity import Lexicon, evidence, fold, score_text

LEXICON = Lexicon(((" idio", 4.0), (" idiot ", 6.0), (" scum", 5.0)), (" pond scum ",), 1.0, -3.0)


def test_folding():
    assert fold("The IDIOT!") == " the idiot "
    for hidden in ("1d10t", "іdіоt", "ídîöt", "ＩＤＩＯＴ", "id​iot"):
        assert fold(hidden) == " idiot ", hidden
    assert fold("p@thetic $cum") == " pathetic scum "
    assert fold("") == "  "


def test_hits_take_the_heaviest_entry_and_skip_exceptions():
    assert toxicity.hits(fold("an idiot here"), LEXICON) == [6.0]
    assert toxicity.hits(fold("idiotic pond scum"), LEXICON) == [4.0]
    assert toxicity.hits(fold("pondscum idio"), LEXICON) == [4.0]


def test_longer_texts_need_more():
    short, long = evidence(fold("scum"), LEXICON), evidence(fold("word " * 5000 + "scum"), LEXICON)
    assert 0 < long < short
    assert score_text(None, LEXICON) == score_text("", LEXICON) < 0.5 < score_text("scum", LEXICON)


@pytest.fixture(scope="module")
def labelled(spark):
    clean = "the garden has many quiet paths number{} and trees"
    docs = [(i, clean.format(i) + (f" a grobnik w{i}" if i % 3 == 0 else " a grobnik stew" if i % 3 == 1 else "")) for i in range(300)]
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id bigint, toxic int")


def test_learning_with_an_exception(labelled):
    docs, labels = labelled
    few = labels.where("toxic = 1 or doc_id % 50 != 4")
    lexicon = toxicity.learn(docs.where("doc_id % 3 != 1 or doc_id < 15"), few)
    assert any(" grobnik".startswith(e.rstrip()) or e.startswith(" grob") for e, _ in lexicon.entries)
    assert " grobnik stew " in lexicon.exceptions
    assert score_text("what a grobnik", lexicon) > 0.5 > score_text("grobnik stew", lexicon)


def test_no_labels_and_empty_tables(spark, labelled):
    docs, labels = labelled
    lexicon = toxicity.learn(docs, labels.limit(0))
    assert lexicon.entries == () and score_text("anything", lexicon) < 0.5
    assert toxicity.score(docs.limit(0), lexicon, ["doc_id"]).collect() == []
    odd = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "", 2)], "doc_id bigint, text string, _label int")
    assert len(toxicity.score(odd, LEXICON, ["doc_id", "_label"]).collect()) == 3
    repeated = spark.createDataFrame([(None, 1), (0, None), (0, 0), (0, 1)], "doc_id bigint, toxic int")
    assert toxicity.learn(docs, repeated).entries == ()


def test_query_against_held_out_labels(spark, tables):
    from lakeloom.llm.queries import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, tables.root).collect()}
    assert len(rows) == tables.documents.count()
    for key, r in rows.items():
        assert r.held_out == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_held_out_recall_and_false_positives(spark):
    """Toxic and clean labels apart: saying 0 always would catch nothing."""
    from lakeloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    if not pathlib.Path(folder).exists():
        pytest.skip("no test tables")
    rows = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, folder).collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if rows[r.doc_id].held_out]
    toxic, clean = ([rows[r.doc_id].predicted for r in labels if r.toxic == k] for k in (1, 0))
    assert toxic and sum(toxic) >= 0.6 * len(toxic) and sum(clean) <= 0.05 * len(clean)


def naive(folded, lexicon):
    """Weights of hits by looking for every entry and phrase at every place."""
    best = {}
    for at in range(len(folded)):
        weights = [w for e, w in lexicon.entries if folded.startswith(e, at) and w > 0]
        excused = any(start <= at < start + len(p) - 1 for p in lexicon.exceptions for start in range(len(folded)) if folded.startswith(p, start))
        if weights and not excused:
            best[at] = max(weights)
    return sorted(best.values())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["gro", "grob", "grobnik", "stew", "a", "grobnik stew", "x grob"]), max_size=12))
def test_hits_against_a_search_at_every_place(words):
    lexicon = toxicity.Lexicon(((" gro", 1.5), (" grobnik ", 2.5), (" st", 0.5)), (" grobnik stew ", " x grob "), 1.0, -4.0)
    folded = fold(" ".join(words))
    assert sorted(toxicity.hits(folded, lexicon)) == naive(folded, lexicon)


def test_long_texts_take_linear_time():
    lexicon = toxicity.Lexicon(((" grob", 1.5),), (" grob stew ",), 1.0, -4.0)
    folded = fold("grob stew " * 200_000)
    start = time.process_time()
    assert toxicity.hits(folded, lexicon) == []
    assert time.process_time() - start < 10


def test_folding_of_digits_and_signs_in_words():
    assert fold("h8ful sc!m 6a9 wow! p|g") == " hbful scim bag wow pig "


def test_names_that_are_taken(spark):
    docs = spark.createDataFrame([(1, "a", 0.5)], "doc_id bigint, text string, score double")
    with pytest.raises(ValueError):
        toxicity.score(docs, LEXICON, docs.columns)
    assert toxicity.score(docs, LEXICON, docs.columns, name="s").columns == ["doc_id", "text", "score", "s"]
