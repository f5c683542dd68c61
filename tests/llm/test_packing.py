"""Packing: exact cutting, window law, best fit, padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeloom.llm import packing
from lakeloom.llm.tokens import TextEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = TextEncoder(PATH)


def ids_of(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'sté1 \n\t  Ġ<|endoftext|>!?日"), max_size=60) | st.text(max_size=40), max_size=5))
def test_encoder_equals_library(texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in ENCODER.encode(texts)] == [ids_of(t) for t in texts]


def test_encoder_with_long_words_and_full_cache(monkeypatch):
    from lakeloom.llm import tokens

    monkeypatch.setattr(tokens, "MOST_KEPT", 5)
    own = TextEncoder(PATH)
    texts = ["a bc def " + "xyz" * 60, "one two three four five six seven", "bc def " * 9, "<|endoftext|> x <|endoftext|>", ""]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [ids_of(t) for t in texts]


def slow_best_fit(lengths, window):
    rooms, out = [], []
    for n in lengths:
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - n)
        else:
            rooms.append(window - n)
        out.append(sorted(rooms))
    return out


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda w: st.tuples(st.just(w), st.lists(st.integers(1, w), max_size=50))))
def test_best_fit_equals_slow_form(case):
    window, lengths = case
    lengths = sorted(lengths, reverse=True)
    numbers, offsets = packing.best_fit(np.array(lengths, dtype=np.int64), window)
    filled = defaultdict(int)
    for n, at, length in zip(numbers.tolist(), offsets.tolist(), lengths, strict=True):
        assert filled[n] == at
        filled[n] += length
    want = slow_best_fit(lengths, window)
    assert sorted(window - f for f in filled.values()) == (want[-1] if want else [])


def check_pieces(rows, texts, window, end_id):
    ids = {k: [*ids_of(t or ""), end_id] for k, t in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(piece) and r.doc_tokens == len(ids[r.doc_id])
    assert by_doc.keys() == texts.keys()
    for k, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[k])
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(by_seq)


def test_pieces_of_documents(spark):
    texts = {0: None, 1: "", 2: "word " * 5000, 3: "tie a", 4: "tie b", 5: "<|endoftext|>", 6: "x" * 9000}
    docs = spark.createDataFrame([(k, t, "x", 3) for k, t in texts.items()], "doc_id bigint, text string, start string, length int")
    rows = packing.pack(packing.cut_documents(docs, PATH, 1, 64), 64).collect()
    check_pieces(rows, texts, 64, 1)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 5, "doc_id bigint, text string")
    rows = packing.pack(packing.cut_documents(docs, PATH, 1)).collect()
    assert len(rows) == 5 and len({(r.sequence_id, r.offset) for r in rows}) == 5
    assert packing.pack(packing.cut_documents(docs.limit(0), PATH, 1)).collect() == []


def test_lengths_out_of_range_raise(spark):
    for bad in (0, 2049, None):
        with pytest.raises(Exception, match="pieces must have"):
            packing.pack(spark.createDataFrame([(1, bad)], "doc_id bigint, length bigint")).collect()


def test_sequences_hold_every_id_and_padding(spark):
    random.seed(4)
    texts = {k: " ".join(random.choice("alpha beta gamma".split()) for _ in range(random.randint(0, 90))) for k in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    packed = packing.pack(packing.cut_documents(docs, PATH, 1, 64, with_ids=True), 64).cache()
    windows = {r.sequence_id: r for r in packing.sequences(packed, 64).collect()}
    for r in packed.collect():
        assert windows[r.sequence_id].input_ids[r.offset : r.offset + r.length] == r.ids
    assert all(len(w.input_ids) == len(w.mask) == len(w.part) == 64 for w in windows.values())
    assert sum(sum(w.mask) for w in windows.values()) == sum(len(ids_of(t)) + 1 for t in texts.values())


def test_query_over_small_tables(spark, tables):
    from lakeloom.llm.queries import QUERIES

    rows = QUERIES["op1_packing"](spark, tables.root).collect()
    texts = {r.doc_id: r.text for r in tables.documents.collect()}
    used = check_pieces(rows, texts, packing.WINDOW, 1)
    assert sum(r.length for r in rows) > 0.97 * (used - 1) * packing.WINDOW
