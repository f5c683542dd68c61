"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time evaluation.

Every task indexes its documents in segments of bounded size: a posting list for each term
that some query has. In a segment, a query's short lists are summed term by term into
accumulators, one sorted list of documents with a known largest value. That list and the
query's long lists are then read together in document order, block by block: each has its
largest value in every block, a block whose values cannot add up to the score of the
query's k-th best document so far is skipped unread, and in the others a document drops out
as soon as the lists still unread cannot lift it to that score. What is skipped could not
be among the k best, so results are exact.

Queries are taken in blocks of bounded size, the documents' statistics are two numbers and
one count for each of a block's terms, and a task passes on no more than the k best
documents of each query, so nothing that grows with the corpus meets in one task but these
rows, which are cut in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.storage import stored

TOP = 50
#: Code points of queries (and 32 for each) that are answered together; their terms travel
#: with the tasks.
QUERY_BLOCK_CHARS = 2_000_000
#: Bytes of text that are indexed together, and documents in a block of a list.
SEGMENT_BYTES, BLOCK = 16 << 20, 64
#: Lists with at most one document in so many of a segment are short.
SHORT = 32
_SALTS = 64

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all characters beyond ASCII, A-Z lowered."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def weight(n_documents: int, document_frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * document_frequency + 1)))


class Block:
    """Some queries and the numbers of their terms."""

    def __init__(self, queries: Sequence[tuple[object, str | None]]):
        self.numbers: dict[bytes, int] = {}
        self.queries = [
            (key, np.array(sorted({self.numbers.setdefault(t, len(self.numbers)) for t in terms(text)}), dtype=np.int64)) for key, text in queries
        ]


def query_blocks(queries: DataFrame, key: str, text: str, most_chars: int = QUERY_BLOCK_CHARS) -> Iterator[Block]:
    """Queries in blocks; the driver holds one row or block at a time, and a longer query is one."""
    held, chars = [], 0
    for row in queries.select(F.col(key), F.col(text)).toLocalIterator():
        size = len(row[1] or "") + 32
        if held and chars + size > most_chars:
            yield Block(held)
            held, chars = [], 0
        held.append((row[0], row[1]))
        chars += size
    if held:
        yield Block(held)


def _statistics(texts: DataFrame, numbers: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and documents that hold each term of ``numbers``."""
    size = len(numbers)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n_documents, n_terms = np.zeros(size, dtype=np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0):
                found = terms(text.as_py())
                n_terms += len(found)
                n_documents += bool(found)
                held = [numbers[t] for t in numbers.keys() & set(found)]
                counts[held] += 1
        there = np.flatnonzero(counts)
        keys = np.concatenate([np.array([-2, -1], dtype=np.int64), there])
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate([np.array([n_documents, n_terms], dtype=np.int64), counts[there]]))], ["term", "n"])

    frequency = np.zeros(size + 2, dtype=np.int64)
    # One row for each term of the block of queries, and two.
    for term, n in texts.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect():
        frequency[term + 2] = n
    return int(frequency[0]), int(frequency[1]), frequency[2:]


class Documents:
    """Some documents' query terms as arrays, until they are indexed."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.terms: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, key: int | None, found: Sequence[bytes], numbers: dict[bytes, int]) -> None:
        counts = Counter([numbers[t] for t in found if t in numbers])
        if counts:
            self.ids.append(key)
            self.lengths.append(len(found))
            self.terms.append(np.fromiter(counts, dtype=np.int64, count=len(counts)))
            self.counts.append(np.fromiter(counts.values(), dtype=np.int64, count=len(counts)))
            self.bytes += sum(map(len, found))


class Segment:
    """Posting lists of some documents: of each term, documents in order with their values."""

    def __init__(self, documents: Documents, weights: np.ndarray, n_documents: int, n_terms: int):
        self.nulls = np.array([key is None for key in documents.ids])
        self.ids = np.array([key or 0 for key in documents.ids], dtype=np.int64)
        term, tf = np.concatenate(documents.terms), np.concatenate(documents.counts)
        document = np.repeat(np.arange(len(self.ids), dtype=np.int64), [len(t) for t in documents.terms])
        lengths = np.array(documents.lengths, dtype=np.int64)
        m = 100 - 50 + (50 * lengths * n_documents) // n_terms
        value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[document]))
        order = np.argsort(term, kind="stable")
        self.document, self.value = document[order], value[order]
        self.terms, self.starts = np.unique(term[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(term))
        self.n_blocks = -(-len(self.ids) // BLOCK)
        self._largest: dict[int, np.ndarray] = {}

    def largest(self, at: int) -> np.ndarray:
        """The largest value of a list in each block."""
        if at not in self._largest:
            self._largest[at] = self._block_largest(self.document[self.starts[at] : self.ends[at]], self.value[self.starts[at] : self.ends[at]])
        return self._largest[at]

    def _block_largest(self, document: np.ndarray, value: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n_blocks, dtype=np.int64)
        if len(document):
            block = document // BLOCK
            first = np.flatnonzero(np.diff(block, prepend=-1))
            out[block[first]] = np.maximum.reduceat(value, first)
        return out

    def accumulators(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term at a time: the sums of short lists, in document order."""
        if not len(lists):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        parts = [slice(self.starts[i], self.ends[i]) for i in lists]
        document, place = np.unique(np.concatenate([self.document[p] for p in parts]), return_inverse=True)
        sums = np.zeros(len(document), dtype=np.int64)
        np.add.at(sums, place, np.concatenate([self.value[p] for p in parts]))
        return document, sums

    def search(self, query: np.ndarray, best: "Best") -> None:
        at = np.flatnonzero(np.isin(self.terms, query, assume_unique=True))
        if not len(at):
            return
        sizes = self.ends[at] - self.starts[at]
        short = sizes * SHORT <= len(self.ids)
        summed = self.accumulators(at[short])
        # The accumulators are one iterator more, with bounds like any list.
        lists = [(summed, self._block_largest(*summed))] if len(summed[0]) else []
        lists += [((self.document[self.starts[i] : self.ends[i]], self.value[self.starts[i] : self.ends[i]]), self.largest(i)) for i in at[~short]]
        bound = np.sum([b for _, b in lists], axis=0)
        begin = 0
        while begin < self.n_blocks:
            # Documents in order, a run of blocks at a time that grows as the threshold settles.
            run = np.arange(begin, min(self.n_blocks, begin + max(8, begin)))
            begin = int(run[-1]) + 1
            run = run[(bound[run] >= best.least) & (bound[run] > 0)]
            if len(run):
                self._read(run, lists, bound, best)

    def _read(self, run: np.ndarray, lists: list, bound: np.ndarray, best: "Best") -> None:
        """The documents of some blocks, lists with the largest bounds first."""
        width = int(run[-1] - run[0] + 1)
        low, high = int(run[0]) * BLOCK, (int(run[-1]) + 1) * BLOCK
        score = np.zeros(width * BLOCK, dtype=np.int64)
        open_blocks = np.zeros(width, dtype=bool)
        open_blocks[run - run[0]] = True
        rest = bound[run[0] : run[-1] + 1].copy()
        alive = np.repeat(open_blocks, BLOCK)
        for (document, value), largest in sorted(lists, key=lambda x: -int(x[1][run].max())):
            part = slice(*np.searchsorted(document, (low, high)))
            if part.stop > part.start:
                there = document[part] - low
                keep = alive[there]
                score[there[keep]] += value[part][keep]
            rest -= largest[run[0] : run[-1] + 1]
            if best.least > 1:
                alive &= score + np.repeat(rest, BLOCK) >= best.least
        found = np.flatnonzero(alive & (score > 0))
        best.add(score[found], self.ids[found + low], self.nulls[found + low])


class Best:
    """The k best documents of one query; equal scores by ascending id, null ids last."""

    def __init__(self, top: int):
        self.top, self.least = top, 1
        self.scores, self.ids, self.nulls = (np.empty(0, dtype=t) for t in (np.int64, np.int64, bool))

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        keep = scores >= self.least
        if not keep.any():
            return
        found = [np.concatenate([old, new[keep]]) for old, new in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls))]
        if len(found[0]) > self.top:
            order = np.lexsort((found[1], found[2], -found[0]))[: self.top]
            found = [column[order] for column in found]
        self.scores, self.ids, self.nulls = found
        if len(self.scores) == self.top:
            self.least = int(self.scores.min())


def _best_rows(docs: DataFrame, block: Block, weights: np.ndarray, n_documents: int, n_terms: int, top: int) -> DataFrame:
    """Each task's best documents of each query: number of the query, document and score."""
    numbers, queries = block.numbers, [q for _, q in block.queries]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in queries]
        held = Documents()

        def search() -> None:
            if held.ids:
                segment = Segment(held, weights, n_documents, n_terms)
                for query, found in zip(queries, best, strict=True):
                    segment.search(query, found)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.add(key, terms(text.as_py()), numbers)
                if held.bytes >= SEGMENT_BYTES:
                    search()
                    held = Documents()
        search()
        for i in range(0, len(best), 1000):
            some = best[i : i + 1000]
            query = np.repeat(np.arange(i, i + len(some), dtype=np.int64), [len(b.ids) for b in some])
            ids = pa.array(np.concatenate([b.ids for b in some]), mask=np.concatenate([b.nulls for b in some]))
            yield pa.RecordBatch.from_arrays([pa.array(query), ids, pa.array(np.concatenate([b.scores for b in some]))], ["query", "document", "score"])

    return docs.mapInArrow(run, "query bigint, document bigint, score bigint")


def search(
    docs: DataFrame, queries: DataFrame, top: int = TOP, id_column: str = "doc_id", text_column: str = "text",
    query_id: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """The ``top`` best documents of every query: the query's id, ``rank`` from 1, the
    document's id and its ``score``, an integer form of BM25 (see ``weight`` and ``Segment``).

    Ids of documents are whole numbers. Every row is a document and every row of ``queries`` a
    query of its own, repeated ids or not; equal scores go by ascending id, null ids last.
    Null and empty texts have no terms: such documents are in no result and such queries
    have none. Only documents that score above zero are returned. Columns other than the
    named ones are not read.
    """
    spark = docs.sparkSession
    key = queries.schema[query_id].dataType.simpleString()
    pairs = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    found = None
    for block in query_blocks(queries, query_id, query_text):
        n_documents, n_terms, frequency = _statistics(pairs.select("text"), block.numbers)
        weights = np.array([weight(n_documents, int(f)) for f in frequency], dtype=np.int64)
        rows = _best_rows(pairs, block, weights, n_documents, n_terms, top)
        names = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(block.queries)], f"query bigint, name {key}")
        # As many rows as tasks times queries times ``top``: cut in parts of a query first.
        order = [F.desc("score"), F.asc_nulls_last("document")]
        part = Window.partitionBy("query", F.pmod(F.xxhash64("document"), F.lit(_SALTS))).orderBy(*order)
        rows = rows.withColumn("_rank", F.row_number().over(part)).where(F.col("_rank") <= top)
        rows = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("_rank") <= top)
        # The names of a block are bounded as its texts are.
        best = stored(rows.join(F.broadcast(names), "query").select(F.col("name").alias(query_id), F.col("_rank").alias("rank"), F.col("document").alias(id_column), "score"), "ranked")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], f"`{query_id}` {key}, rank int, `{id_column}` bigint, score bigint")
    return found
