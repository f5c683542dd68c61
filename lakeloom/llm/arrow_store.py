"""Token ids in Arrow files of fixed-size-list batches.

Documents are range partitioned and sorted by id; every task writes its documents' ids, one
after another, as sequences of equal length with a mask of the same length, in an Arrow
stream with a footer (the IPC file format), and beside it an index of where each document
starts. All batches but the last of a file hold as many sequences, so the place of any token
is known without a search, and a mapped file gives sequences and masks without a copy.

Ids take two bytes where the vocabulary allows it. A task's files have a name of their own
for each attempt, and the manifest lists those of the attempts that counted, so a task that
runs again does no harm. Files go to the folder that all executors share.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.storage import stored
from lakeloom.llm.tokens import ID, encoder
from lakeloom.session import scratch_path

SEQUENCE, BATCH = 2048, 256


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def _opened(uri: str) -> pa.NativeFile:
    """A local file is mapped, so batches are views of it."""
    from pyarrow import fs

    files, path = file_system(uri)
    return pa.memory_map(path) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(path)


class TokenWriter:
    """Writes ids to one file, sequence after sequence."""

    def __init__(self, sink, dtype: np.dtype, sequence: int = SEQUENCE):
        self.sequence, self.dtype, self.n_tokens = sequence, dtype, 0
        value = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("input_ids", pa.list_(value, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        self._writer = pa.ipc.new_file(sink, self.schema)
        self._pending: list[np.ndarray] = []
        self._held = 0

    def add(self, ids: np.ndarray) -> int:
        """Append a document's ids and return where they start."""
        start, self.n_tokens = self.n_tokens, self.n_tokens + len(ids)
        self._pending.append(ids.astype(self.dtype))
        self._held += len(ids)
        if self._held >= BATCH * self.sequence:
            self._flush(False)
        return start

    def _flush(self, last: bool) -> None:
        whole, size = np.concatenate(self._pending or [np.empty(0, self.dtype)]), BATCH * self.sequence
        at = 0
        while len(whole) - at >= size or (last and at < len(whole)):
            ids = whole[at : at + size]
            padding = -len(ids) % self.sequence
            mask = np.arange(len(ids) + padding) < len(ids)
            values = pa.array(np.concatenate([ids, np.zeros(padding, self.dtype)]))
            columns = [pa.FixedSizeListArray.from_arrays(x, self.sequence) for x in (values, pa.array(mask))]
            self._writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
            at += size
        self._pending, self._held = [whole[at:]], max(0, len(whole) - at)

    def close(self) -> None:
        self._flush(True)
        self._writer.close()


class TokenFile:
    """Random access to a file of sequences."""

    def __init__(self, uri: str):
        self._reader = pa.ipc.open_file(_opened(uri))
        self.sequence = self._reader.schema.field("input_ids").type.list_size
        self._values: dict[int, np.ndarray] = {}

    def sequences(self, batch: int) -> pa.RecordBatch:
        return self._reader.get_batch(batch)

    def _flat(self, batch: int) -> np.ndarray:
        if batch not in self._values:
            self._values = {batch: self.sequences(batch).column(0).flatten().to_numpy(zero_copy_only=True)}
        return self._values[batch]

    def ids(self, start: int, length: int) -> np.ndarray:
        """Ids from ``start`` on, across sequences and batches, as unsigned 32-bit integers."""
        size, parts = BATCH * self.sequence, []
        while length:
            batch, at = divmod(start, size)
            part = self._flat(batch)[at : at + length]
            parts.append(part)
            start, length = start + len(part), length - len(part)
        return np.concatenate(parts).astype(ID) if parts else np.empty(0, ID)


@dataclass(frozen=True)
class TokenStore:
    """Written files: a frame of ``part``, ``tokens``, ``index``, ``start`` (ids in earlier
    files), ``n_tokens`` and ``n_docs``, and their number."""

    manifest: DataFrame
    files: int
    id_column: str
    id_type: str


def write(
    docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, id_column: str = "doc_id", text_column: str = "text", sequence: int = SEQUENCE
) -> TokenStore:
    """Encode every row's whole text, append ``end_id`` and write ids in ascending order of
    the id column (nulls first, ties by text). A null text counts as empty and is the end id
    alone; repeated rows are written each; an empty table gives no files. Columns other than
    the two named are not read."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    key = docs.schema[id_column]
    arrow_key = pa.string() if key.dataType.typeName() == "string" else pa.int64()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = encoder(vocabulary)
        dtype = np.dtype("<u2" if max(coder.size, end_id + 1) <= 1 << 16 else "<u4")
        end, part = np.array([end_id], dtype=ID), TaskContext.get().partitionId()
        files, path = file_system(folder)
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        writer = index = None
        n_docs = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                files.create_dir(path, recursive=True)
                tokens, places = files.open_output_stream(f"{path}/{name}.tokens.arrow"), files.open_output_stream(f"{path}/{name}.index.arrow")
                writer = TokenWriter(tokens, dtype, sequence)
                schema = pa.schema([(key.name, arrow_key), ("start", pa.int64()), ("n_tokens", pa.int64())])
                index = pa.ipc.new_file(places, schema)
            found = [np.concatenate([np.frombuffer(x, ID), end]) for x in coder.encode([t or "" for t in batch.column(1).to_pylist()])]
            starts = pa.array([writer.add(ids) for ids in found], pa.int64())
            index.write_batch(pa.RecordBatch.from_arrays([batch.column(0).cast(arrow_key), starts, pa.array([len(x) for x in found], pa.int64())], schema=schema))
            n_docs += len(found)
        if writer is not None:
            writer.close()
            index.close()
            tokens.close()
            places.close()
            uris = [f"{folder}/{name}.{kind}.arrow" for kind in ("tokens", "index")]
            yield pa.RecordBatch.from_pydict({"part": [part], "tokens": uris[:1], "index": uris[1:], "n_tokens": [writer.n_tokens], "n_docs": [n_docs]})

    placed = docs.select(id_column, text_column).repartitionByRange(id_column).sortWithinPartitions(id_column, text_column)
    listed = stored(placed.mapInArrow(run, "part bigint, tokens string, index string, n_tokens bigint, n_docs bigint"), "manifest")
    # One row for each file.
    earlier = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return TokenStore(listed.withColumn("start", earlier), listed.count(), id_column, key.dataType.simpleString())


def read(store: TokenStore) -> DataFrame:
    """Each document's id, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32`` (of its ids as little-endian unsigned 32-bit integers), from the files."""
    id_column = store.id_column

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens, index, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                file, listed = TokenFile(tokens), pa.ipc.open_file(_opened(index))
                for i in range(listed.num_record_batches):
                    keys, starts, lengths = listed.get_batch(i).columns
                    crcs = [zlib.crc32(file.ids(s, n).tobytes()) for s, n in zip(starts.to_pylist(), lengths.to_pylist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.compute.add(starts, before), lengths, pa.array(crcs, pa.int64())], [id_column, "start", "n_tokens", "ids_crc32"]
                    )

    kind = "string" if store.id_type == "string" else "bigint"
    files = store.manifest.select("tokens", "index", "start").repartition(max(1, store.files))
    return files.mapInArrow(run, f"`{id_column}` {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
