"""Packing of token sequences into windows of equal length: best-fit decreasing.

Documents are tokenized and cut where they lie; a document longer than a window is first
cut into full windows. What is shuffled is a few numbers for each piece, not its ids, in
partitions whose size adaptive execution chooses. Each partition is packed on its own: its
pieces, longest first, go to the open window with the least room that still holds them,
which a segment tree indexed by remaining room finds in a logarithmic number of steps. Only
the last windows of a partition stay partly empty, so padding falls with partition size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.tokens import ID, encoder

WINDOW = 2048
#: Windows of one partition are numbered below this bit, the partition above it.
_NUMBER_BITS = 33


class OpenWindows:
    """Open windows by remaining room. A node of the tree says whether any window below it
    is open; leaf ``r`` holds the windows with room for ``r`` more tokens."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.any_open = bytearray(2 * self.leaves)
        self.at_room: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, number: int, room: int) -> None:
        if room == 0:
            return
        self.at_room[room].append(number)
        node = room + self.leaves
        while node and not self.any_open[node]:
            self.any_open[node] = 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The tightest window that holds ``length`` tokens, and its room, or None."""
        node, tree = length + self.leaves, self.any_open
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not tree[2 * node])
        room = node - self.leaves
        number = self.at_room[room].pop()
        if not self.at_room[room]:
            tree[node] = 0
            while node > 1:
                node >>= 1
                if tree[2 * node] or tree[2 * node + 1]:
                    break
                tree[node] = 0
        return number, room


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset for pieces given in falling order of length."""
    open_windows, made = OpenWindows(window), 0
    numbers, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    for i, length in enumerate(lengths.tolist()):
        found = open_windows.take(length)
        if found is None:
            number, room, made = made, window, made + 1
        else:
            number, room = found
        numbers[i], offsets[i] = number, window - room
        open_windows.add(number, room - length)
    return numbers, offsets


def cut_documents(
    docs: DataFrame, vocabulary: str, end_id: int, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``window`` tokens: the document's id, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens`` and, if asked for, ``ids``.

    A null text counts as empty and gives one piece with the end id alone; each row of
    a repeated id is cut on its own; columns other than the two named are not read.
    """
    key = docs.schema[id_column]
    fields = [f"`{key.name}` {key.dataType.simpleString()}", "start bigint", "length bigint", "ids_crc32 bigint", "doc_tokens bigint"]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary).encode, np.array([end_id], dtype=ID).tobytes()
        for batch in batches:
            rows, start, length, crc, total, ids = [], [], [], [], [], []
            for row, data in enumerate(encode([t or "" for t in batch.column(1).to_pylist()])):
                data += end
                n = len(data) // ID.itemsize
                for at in range(0, n, window):
                    piece = data[at * ID.itemsize : (at + window) * ID.itemsize]
                    rows.append(row)
                    start.append(at)
                    length.append(len(piece) // ID.itemsize)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(piece, dtype=ID).astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            names = [key.name, "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_column, text_column).mapInArrow(cut, ", ".join(fields + ["ids array<int>"] * with_ids))


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``window``;
    a piece that is longer, empty or null raises.

    Rows with ties in length keep a fixed order, so a task that runs again packs alike.
    An empty table stays empty; other columns are carried along.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not len(table):
            return
        context = TaskContext.get()
        lengths = table.column("length").to_numpy()
        if table.column("length").null_count or lengths.min() < 1 or lengths.max() > window:
            raise ValueError(f"pieces must have 1 to {window} tokens")
        plain = [(c, "ascending") for c in table.column_names if c != "length" and pa.types.is_integer(table.schema.field(c).type)]
        order = pa.compute.sort_indices(table, sort_keys=[("length", "descending"), *plain])
        table = table.take(order)
        numbers, offsets = best_fit(table.column("length").to_numpy(), window)
        table = table.append_column("sequence_id", pa.array(numbers + (context.partitionId() << _NUMBER_BITS)))
        yield from table.append_column("offset", pa.array(offsets)).to_batches(max_chunksize=20_000)

    return pieces.hint("rebalance").mapInArrow(place, schema + ", sequence_id bigint, offset bigint")


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """Padded windows of pieces that carry ``ids``: ``sequence_id``, ``input_ids``,
    ``mask`` (1 for a token) and ``part`` (the piece's place in its window, from 1)."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    grouped = packed.groupBy("sequence_id").agg(ordered.alias("pieces"), F.sum("length").alias("filled"))
    padding = F.array_repeat(F.lit(pad_id), (F.lit(window) - F.col("filled")).cast("int"))
    parts = F.flatten(F.transform("pieces", lambda p, i: F.array_repeat(i + 1, p["length"].cast("int"))))
    none = F.array_repeat(F.lit(0), (F.lit(window) - F.col("filled")).cast("int"))
    return grouped.select(
        "sequence_id",
        F.concat(F.flatten(F.transform("pieces", lambda p: p["ids"])), padding).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.col("filled").cast("int")), none).alias("mask"),
        F.concat(parts, none).alias("part"),
    )
