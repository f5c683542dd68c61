"""The pipeline: each stage against its operator or brute force on the stage's own input."""

import corpus_pipeline
from test_jaccard import brute
from test_packing import check_pieces

from lakeloom.llm import packing


def test_stages_over_small_tables(spark, tables):
    docs = tables.documents
    labels = {r.doc_id: r for r in tables.labels.collect()}
    states = [docs]
    for _, stage in corpus_pipeline.STAGES:
        states.append(stage(spark, states[-1], tables.root).cache())
    assert all(s.columns == docs.columns for s in states[:-1])
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in states]
    assert ids[0] > ids[1] > ids[2] and ids[2] >= ids[3]
    gone = [labels[i] for i in ids[0] - ids[1] if i in labels]
    assert gone and all(r.toxic == 1 for r in gone)
    # Texts of less than 20 words fail the base rules whatever their label says.
    short = {r.doc_id for r in states[1].collect() if len((r.text or "").split()) < 20}
    poor = [labels[i] for i in ids[1] - ids[2] - short if i in labels]
    assert poor and sum(r.quality == 0 for r in poor) >= 0.8 * len(poor)
    texts = {r.doc_id: r.text for r in states[2].collect()}
    assert ids[3] == {c for _, c in brute(texts).values()}
    check_pieces(states[4].collect(), {k: texts[k] for k in ids[3]}, packing.WINDOW, 1)


def test_repeated_rows_and_empty_tables(spark, tables):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, None)], "doc_id bigint, text string")
    kept = corpus_pipeline.one_of_near_copies(spark, docs, tables.root).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id is not None) == [(1, "a b c d e f")] and len(kept) == 3
    empty = tables.documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, tables.root)
    assert empty.collect() == []


def test_run(spark, tables):
    rows = corpus_pipeline.run(spark, tables.root + "/").collect()
    assert rows and {"doc_id", "sequence_id", "offset", "length"} <= set(rows[0].asDict())
