"""Token files: exact ids, equal sequences, masks, order, repeated tasks."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeloom.llm import arrow_store

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def want(texts, end_id=2):
    """(doc_id, start, n_tokens, crc) of texts given as sorted pairs."""
    start, out = 0, []
    for key, text in texts:
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_hold_sequences_masks_and_documents(spark, tmp_path):
    texts = [(i, f"text {i} " * (i % 40)) for i in range(200)] + [(200, None), (201, ""), (202, "long " * 9000)]
    docs = spark.createDataFrame([(k, t, "s", 1) for k, t in reversed(texts)], "doc_id bigint, text string, tokens string, start int")
    store = arrow_store.write(docs, PATH, 2, folder=f"file://{tmp_path}", sequence=64)
    rows = arrow_store.read(store).collect()
    assert sorted(map(tuple, rows)) == want(texts)
    total = 0
    for part in store.manifest.orderBy("part").collect():
        file = arrow_store.TokenFile(part.tokens)
        batches = [file.sequences(i) for i in range(file._reader.num_record_batches)]
        assert all(b.num_rows == arrow_store.BATCH for b in batches[:-1])
        assert all(b.schema.field(0).type == pa.list_(pa.uint16(), 64) for b in batches)
        filled = sum(sum(b.column(1).flatten().to_pylist()) for b in batches)
        assert filled == part.n_tokens and part.start == total
        total += filled


@pytest.mark.parametrize("lengths", [[0], [1], [63, 1, 64], [5] * 4000, [70_000]])
def test_writer_and_random_access(tmp_path, lengths):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, n).astype("<u4") for n in lengths]
    with pa.OSFile(str(tmp_path / "x.arrow"), "wb") as sink:
        writer = arrow_store.TokenWriter(sink, np.dtype("<u2"), 16)
        starts = [writer.add(d) for d in docs]
        writer.close()
    file = arrow_store.TokenFile(f"file://{tmp_path}/x.arrow")
    for i in reversed(range(len(docs))):
        assert file.ids(starts[i], len(docs[i])).tolist() == docs[i].tolist()


def test_empty_table_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (None, "n")], "doc_id bigint, text string")
    rows = arrow_store.read(arrow_store.write(docs, PATH, 2)).collect()
    assert sorted((tuple(r) for r in rows), key=lambda r: r[1]) == want([(None, "n"), (1, "a"), (1, "a"), (1, "b")])
    assert arrow_store.read(arrow_store.write(docs.limit(0), PATH, 2)).collect() == []


def test_query_over_small_tables(spark, tables):
    from lakeloom.llm.queries import QUERIES

    rows = QUERIES["op7_token_files"](spark, tables.root).collect()
    assert sorted(map(tuple, rows)) == want(sorted((r.doc_id, r.text) for r in tables.documents.collect()))
