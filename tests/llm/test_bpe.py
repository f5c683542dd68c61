"""BPE by the trie against the tokenizers library and against the merge rule."""

import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
CODER = bpe.PrefixEncoder(PATH)


def as_list(data):
    return np.frombuffer(data, "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aeint'sdrlmvé1!  \n\tĠ<|endoftext|>日"), max_size=80) | st.text(max_size=50), max_size=4))
def test_ids_and_way_back(texts):
    found = CODER.encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert as_list(ids) == TOKENIZER.encode(text, add_special_tokens=False).ids
        assert CODER.decode(ids) == TOKENIZER.decode(as_list(ids), skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text(alphabet="theingoras", min_size=1, max_size=25), max_size=30))
def test_trie_equals_merge_rule(words):
    words = sorted(words)
    want = [[CODER.vocabulary.ids[t] for t in CODER.vocabulary.merge(w.encode())] for w in words]
    assert [as_list(x) for x in CODER.encode_words(words)] == want


def test_long_words_and_full_caches(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_KEPT", 20)
    monkeypatch.setattr(bpe, "MOST_PAIRS", 10)
    monkeypatch.setattr(bpe, "TRIE_WORDS", 3)
    own = bpe.PrefixEncoder(PATH)
    texts = ["x" * 500, "-" * 300 + "ab", "the then there them thesis " * 4, " ".join(str(i) for i in range(60))]
    for _ in range(2):
        assert [as_list(x) for x in own.encode(texts)] == [TOKENIZER.encode(t).ids for t in texts]


def test_characters_newer_than_the_library():
    for text in ("a\ua7ce1\u088f! \u0c5c\u0c5c", "\U00010940 x\u0558"):
        assert as_list(CODER.encode([text])[0]) == TOKENIZER.encode(text).ids


def digest(data):
    return hashlib.sha256(data).hexdigest()


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = TOKENIZER.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == digest(TOKENIZER.decode(ids, skip_special_tokens=False).encode())


def test_frames(spark):
    texts = {1: None, 2: "", 3: "a " * 3000, 4: "<|endoftext|> end", 5: " 　 wide"}
    docs = spark.createDataFrame([(k, t, k) for k, t in texts.items()], "doc_id bigint, text string, ids int")
    check(bpe.round_trip(docs, PATH).collect(), texts)
    encoded = bpe.encode(docs, PATH)
    assert {r.doc_id: r.text for r in bpe.decode(encoded, PATH).collect()} == {k: t or "" for k, t in texts.items()}
    assert bpe.round_trip(docs.limit(0), PATH).collect() == []
    assert len(set(map(tuple, bpe.round_trip(docs.union(docs), PATH).collect()))) == len(texts)


def test_query_over_small_tables(spark, tables):
    from lakeloom.llm.queries import QUERIES

    check(QUERIES["op5_bpe"](spark, tables.root).collect(), {r.doc_id: r.text for r in tables.documents.collect()})
