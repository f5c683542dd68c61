"""Jaccard join of documents on word n-grams, by PartEnum signatures.

Two sets with a Jaccard similarity of at least s differ in at most (a + b)(1 - s)/(1 + s)
elements, a and b being their sizes. Sizes fall into bands; a set takes part in the bands
that its own size and that of a larger partner can fall into, and in a band whose largest
size is r no linked pair differs in more than k = 2r(1 - s)/(1 + s) elements. In each band
the domain of elements is split by hash into more than k parts. A pair that differs in k
elements agrees in all parts but k, so of any k + 1 parts of a set that hold something one
is the same in a linked set: the hash of a part's content is the signature they share, the
subsets of parts being single parts.

Which k + 1 parts count may be chosen by any property of their content, the same for all
sets: take of two linked sets the stricter one; the part they share passes for the other
too. Here the rarest signatures are chosen, those with the fewest sets. So passages that many
texts share do not bring them together: a text has enough parts with something of its own,
and often those alone prove that it has no partner. Sets whose elements crowd into k parts or
fewer give all parts and each element; two such sets that are linked share an element.

Equal sets are one node. Sets that share a chosen signature are candidates: first each is
checked against two partners of its signature group. Where a group still lies in several
components its sets meet once more in a task, without becoming rows for each pair: their
parities, one bit for each of a thousand classes of elements, are compared as arrays, and
pairs of different components that sizes and parities do not rule out are to be checked
exactly. A pair meets in many signatures, so groups with the same least member, which near
copies mostly have, go to one task, where a pair counts once. Of these pairs first a forest,
nearest pairs first, comes out and is checked, fewer rows than there are components; what it
links needs no more pairs, and only the groups with further pairs are compared once more.
Large groups are dealt out in blocks. Pairs inside a component need no check, so groups of
thousands of near copies do not turn into all their pairs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.components import components
from lakeloom.llm.storage import discard, stored
from lakeloom.operators.layout import many_to_one, replicate_counted

WORDS, PERCENT = 5, 80
_U = np.uint64
#: Odd multipliers of the words of an n-gram; more words than these use them again, shifted.
_MULTIPLIERS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]
#: Sets that a task remembers as given.
_MOST_KEPT = 1_000_000
_PARITY_BITS = 1024
#: Sets of one signature that a task compares at once; larger groups are dealt out in blocks.
_BLOCK = 8192
#: Rows of groups with the same least member that go to one task.
_SHARE = 1 << 16
#: Pairs that a task holds before it gives them, each once.
_MOST_PAIRS = 500_000


def _mix(x: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash."""
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = _mix(np.arange(1, 257, dtype=_U) * _U(_MULTIPLIERS[0]))
_BASE = 0x2545F4914F6CDD1D
#: Bytes of text whose words are hashed at once.
_PIECE = 1 << 18


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    found = np.full(size, base, dtype=_U)
    found[0] = 1
    return np.cumprod(found, dtype=_U)


def _hashes_of_words(piece: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word of some bytes: a polynomial in numbers that stand for its
    bytes, from running sums over the piece, mixed."""
    if not len(piece):
        return np.empty(0, dtype=_U)
    space = _SPACE[piece]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.append(0, edge)
    if not space[-1]:
        edge = np.append(edge, len(piece))
    size = max(_PIECE, 1 << int(len(piece) - 1).bit_length())
    starts, ends = edge[::2], edge[1::2]
    running = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(_BYTES[piece] * _powers(_BASE, size)[: len(piece)], dtype=_U)])
    return _mix((running[ends] - running[starts]) * _powers(pow(_BASE, -1, 1 << 64), size)[starts])


def _word_hashes(data: bytes) -> np.ndarray:
    """Hashes of all words; long texts in pieces that end between words."""
    whole = np.frombuffer(data, dtype=np.uint8)
    out, at = [], 0
    while len(data) - at > _PIECE:
        stop = at + _PIECE
        gaps = np.flatnonzero(_SPACE[whole[at:stop]])
        while not len(gaps) and stop < len(data):  # a word longer than the piece
            more = np.flatnonzero(_SPACE[whole[stop : stop + _PIECE]])
            gaps, stop = more + stop - at, stop + _PIECE
        stop = at + int(gaps[-1]) + 1 if len(gaps) else len(data)
        out.append(_hashes_of_words(whole[at:stop]))
        at = stop
    out.append(_hashes_of_words(whole[at:]))
    return out[0] if len(out) == 1 else np.concatenate(out)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams, letters A to Z lowered."""
    hashes = _word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    n = len(hashes) - width + 1
    total = np.full(n, width, dtype=_U)
    for i in range(width):
        total += _mix(hashes[i : i + n] + _U(i)) * _U(_MULTIPLIERS[i % len(_MULTIPLIERS)] + 2 * (i // len(_MULTIPLIERS)))
    total = np.sort(_mix(total))
    return total[np.append(True, total[1:] != total[:-1])]


@lru_cache(maxsize=4)
def _bands(percent: int) -> list[int]:
    """Largest sizes of bands; each is the size a set of the last band's can be linked to."""
    tops = [max(1, percent // (100 - percent) if percent < 100 else 1)]
    while tops[-1] < 1 << 40:
        tops.append(max(tops[-1] + 1, tops[-1] * 100 // percent))
    return tops


def signatures(elements: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """PartEnum signatures of a set of 64-bit hashes, with the band of each and the number of
    signatures that the band can ``spare`` (-1: none may be left out)."""
    n = len(elements)
    if not n:
        return np.empty(0, dtype=_U), np.empty(0, dtype=np.int16), np.empty(0, dtype=np.int32)
    tops = _bands(percent)
    # Parts are ranges of the hashes, which are sorted, so a part's content is a difference
    # of running sums.
    running = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(_mix(elements), dtype=_U)])
    high = elements >> _U(32)
    out, bands, spares = [], [], []
    for band in range(bisect_left(tops, n), bisect_left(tops, n * 100 // percent) + 1):
        k = 2 * tops[band] * (100 - percent) // (100 + percent)
        part = (high * _U(1 if not k else k + 2 + k // 5)) >> _U(32)
        ends = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, n)
        content = np.diff(running[ends], prepend=running[:1])
        found = _mix(content ^ _mix((_U(band) << _U(40)) + part[ends - 1]))
        spare = len(ends) - (k + 1)
        if spare < 0:
            found = np.concatenate([found, _mix(elements ^ _U(0xA5A5A5A5 + band))])
        out.append(found)
        bands.append(np.full(len(found), band, dtype=np.int16))
        spares.append(np.full(len(found), max(spare, -1), dtype=np.int32))
    return np.concatenate(out), np.concatenate(bands), np.concatenate(spares)


def _parity(elements: np.ndarray) -> np.ndarray:
    """One bit for each of ``_PARITY_BITS`` classes of elements: whether their number is odd.
    Two sets differ in at least as many elements as their bits differ."""
    odd = np.bincount((elements >> _U(7)).astype(np.int64) & (_PARITY_BITS - 1), minlength=_PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """Each row's id, two hashes of its set (null for an empty one), its size and parity."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two, size, parity = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text, words)
                data = found.tobytes()
                size.append(len(found))
                one.append(xxhash.xxh3_64_intdigest(data) - (1 << 63) if data else None)
                two.append(xxhash.xxh64_intdigest(data, seed=7) - (1 << 63) if data else None)
                parity.append(_parity(found))
            numbers = [pa.array(x, pa.int64()) for x in (one, two, size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(parity, pa.list_(pa.int64()))], ["id", "k1", "k2", "n", "parity"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), text_column).mapInArrow(run, f"id {kind}, k1 bigint, k2 bigint, n bigint, parity array<bigint>")


def _signature_rows(docs: DataFrame, words: int, percent: int, text_column: str) -> DataFrame:
    """``sig``, ``k1``, ``band`` and ``spare`` of every text; a task gives those of equal sets once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            texts = batch.column(0)
            for i in range(0, len(texts), 500):
                keys, found_rows = [], []
                for text in texts.slice(i, 500).to_pylist():
                    found = shingles(text, words)
                    key = xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)
                    if not len(found) or key in seen:
                        continue
                    if len(seen) >= _MOST_KEPT:
                        seen.clear()
                    seen.add(key)
                    keys.append(key)
                    found_rows.append(signatures(found, percent))
                if keys:
                    sig, band, spare = (np.concatenate(c) for c in zip(*found_rows, strict=True))
                    key_rows = np.repeat(np.array(keys, dtype=np.int64), [len(r[0]) for r in found_rows])
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (sig.view(np.int64), key_rows, band, spare)], ["sig", "k1", "band", "spare"])

    return docs.select(text_column).mapInArrow(run, "sig bigint, k1 bigint, band smallint, spare int")


def _chosen(rows: DataFrame) -> DataFrame:
    """``sig`` and ``k1`` of the signatures that several sets have and that are among the rarest
    of their set and band."""
    # Rows of a signature meet in one task: some numbers each, equal sets folded before.
    group = Window.partitionBy("sig")
    shared = rows.withColumns({"_least": F.min("k1").over(group), "_most": F.max("k1").over(group), "size": F.count(F.lit(1)).over(group)})
    shared = shared.where("_least < _most").drop("_least", "_most").distinct()
    # All signatures that only one set has come first; of the others as many are needed as
    # exceed what the band can spare, and those of equal size with the last of them.
    of_set = Window.partitionBy("k1", "band")
    ranked = shared.withColumns({"_rank": F.row_number().over(of_set.orderBy("size", "sig")), "_shared": F.count(F.lit(1)).over(of_set)})
    needed = F.when(F.col("spare") < 0, F.col("_shared")).otherwise(F.col("_shared") - F.col("spare"))
    bound = F.max(F.when(F.col("_rank") == needed, F.col("size"))).over(of_set)
    return ranked.withColumn("_bound", bound).where("size <= _bound").select("sig", "k1").distinct()


def _set_arrays(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                found = [shingles(t, words) for t in part.column(1).to_pylist()]
                keys = [xxhash.xxh3_64_intdigest(f.tobytes()) - (1 << 63) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(keys, pa.int64()), pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))], ["id", "k1", "elements"]
                )

    return docs.select("id", "text").mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, k1 bigint, elements array<bigint>")


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes that sizes and parities do not rule out."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    differ = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n)
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(near & (differ * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))).select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes whose sets are similar enough, stored. Texts of documents in pairs
    are read again; of a repeated id the text that has the node's set counts."""
    wanted = stored(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "wanted")
    chosen = docs.join(replicate_counted(wanted.select("node.id").distinct()), "id", "left_semi")
    arrays = _set_arrays(chosen, words).select(F.struct("id", "k1").alias("node"), "elements")
    sets = stored(arrays.groupBy("node").agg(F.first("elements").alias("elements")), "elements")
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("_ea"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("_eb"))
    common = F.size(F.array_intersect("_ea", "_eb"))
    either = F.size("_ea") + F.size("_eb") - common
    found = stored(pairs.join(left, "a").join(right, "b").where(common * 100 >= F.lit(percent) * either).select("a", "b"), "links")
    discard(wanted, sets)
    return found


def _differ(parity: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """In how many bits parities differ, for pairs of places."""
    out = np.empty(len(p), dtype=np.int64)
    for i in range(0, len(p), 1 << 16):
        a, b = p[i : i + (1 << 16)], q[i : i + (1 << 16)]
        # Bits of a negative number are counted in its absolute value.
        out[i : i + (1 << 16)] = np.bitwise_count((parity[a] ^ parity[b]).view(_U)).sum(axis=1, dtype=np.int64)
    return out


def _close(n: np.ndarray, parity: np.ndarray, p: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and parities leave room for a link, for pairs of places."""
    return _differ(parity, p, q) * (100 + percent) <= (n[p] + n[q]) * (100 - percent)


def forest(a: np.ndarray, b: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Which pairs of components (a, b) connect what all nearer ones leave apart."""
    above: dict[int, int] = {}

    def top(c: int) -> int:
        while (up := above.get(c, c)) != c:
            above[c] = above.get(up, up)
            c = up
        return c

    out = np.zeros(len(a), dtype=bool)
    lefts, rights = a.tolist(), b.tolist()
    for i in np.argsort(far, kind="stable").tolist():
        u, v = top(lefts[i]), top(rights[i])
        if u != v:
            above[u] = v
            out[i] = True
    return out


def near_pairs(n: np.ndarray, component: np.ndarray, parity: np.ndarray, side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of different components, not both of side 1 or both of side 2, that
    sizes and parities do not rule out."""
    order = np.argsort(n, kind="stable")
    n, component, parity, side = n[order], component[order], parity[order], side[order]
    lefts, rights = [], []
    for start in range(0, len(n), 64):
        stop = min(start + 64, len(n))
        # Sets beyond the size that the largest of these can be linked to are not near.
        end = int(np.searchsorted(n, n[stop - 1] * 100 // percent, side="right"))
        x, y = slice(start, stop), slice(start, end)
        met = (component[x, None] != component[None, y]) & (n[x, None] * 100 >= n[None, y] * percent)
        met &= np.arange(start, stop)[:, None] < np.arange(start, end)[None, :]
        met &= (side[x, None] != side[None, y]) | (side[x, None] == 0)
        a, b = np.nonzero(met)
        p, q = a + start, b + start
        close = _close(n, parity, p, q, percent)
        lefts.append(order[p[close]])
        rights.append(order[q[close]])
    return (np.concatenate(lefts), np.concatenate(rights)) if lefts else (np.empty(0, dtype=np.int64),) * 2


def near_pairs_of_groups(starts: np.ndarray, n: np.ndarray, component: np.ndarray, parity: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for many small groups at once, one after another from ``starts`` on, which ends
    with the number of rows."""
    ends = np.repeat(starts[1:], np.diff(starts))
    later = ends - 1 - np.arange(len(n))
    p = np.repeat(np.arange(len(n)), later)
    q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(later) - later, later)
    met = (component[p] != component[q]) & (np.minimum(n[p], n[q]) * 100 >= np.maximum(n[p], n[q]) * percent)
    p, q = p[met], q[met]
    close = _close(n, parity, p, q, percent)
    return p[close], q[close]


def _pairs_across(rows: DataFrame, percent: int, sparse: bool) -> DataFrame:
    """Pairs of keys (x, y) from rows of ``sig``, ``members``, ``least``, ``share``, ``k1``, ``n``,
    ``comp`` (a number for the component) and ``parity``: sets of one signature in different
    components. A ``sparse`` result has of the pairs that a task finds those of a forest, and a
    row with ``sig`` alone for groups that hold the others."""
    blocks = F.ceil(F.col("members") / F.lit(_BLOCK))
    own = F.pmod(F.xxhash64("k1"), blocks)
    # A group of several blocks goes to a task for each two of them.
    deals = F.transform(F.sequence(F.lit(0).cast("bigint"), blocks - 1), lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), F.when(own < other, 1).when(own > other, 2).otherwise(0).alias("side")))
    dealt = rows.select("least", "share", "sig", "k1", "n", "comp", "parity", F.explode(deals).alias("d")).select("least", "share", "sig", "d.i", "d.j", "d.side", "k1", "n", "comp", "parity")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: list[tuple[np.ndarray, ...]] = []

        def given(x: np.ndarray, y: np.ndarray, sig: np.ndarray) -> pa.RecordBatch:
            """Pairs, and rows for groups."""
            none = np.zeros(len(x) + len(sig), dtype=np.int64)
            pair = np.arange(len(none)) < len(x)
            columns = [np.concatenate([c, none[len(c) :]]) for c in (x, y)] + [np.concatenate([none[: len(x)], sig])]
            return pa.RecordBatch.from_arrays([pa.array(c, mask=m) for c, m in zip(columns, (~pair, ~pair, pair), strict=True)], ["x", "y", "sig"])

        def once() -> Iterator[pa.RecordBatch]:
            """What was met, each pair once."""
            x, y, sig, cx, cy, far = (np.concatenate(c) for c in zip(*met, strict=True))
            met.clear()
            order = np.lexsort((sig, y, x))
            first = order[np.append(True, (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0))]
            x, y, sig, cx, cy, far = (c[first] for c in (x, y, sig, cx, cy, far))
            kept = forest(cx, cy, far) if sparse else np.ones(len(x), dtype=bool)
            yield given(x[kept], y[kept], np.unique(sig[~kept]))

        def named(sig: np.ndarray, keys: np.ndarray, n: np.ndarray, comp: np.ndarray, parity: np.ndarray, found: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
            a, b = found
            if len(a):
                met.append((np.minimum(keys[a], keys[b]), np.maximum(keys[a], keys[b]), sig[a], comp[a], comp[b], _differ(parity, a, b) / (n[a] + n[b])))
            if sum(len(m[0]) for m in met) > _MOST_PAIRS:
                yield from once()

        def of_rows(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            """Pairs of whole groups: large ones one by one, small ones together, so many that
            there are a few million pairs at most."""
            names, keys, n, comp, parity, side = (np.concatenate(c) for c in zip(*held, strict=True))
            sig = names[:, 0]
            starts = np.concatenate([[0], np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1, [len(names)]])
            sizes = np.diff(starts)
            large = (sizes > 256) | (side[starts[:-1]] > 0)
            for g in np.flatnonzero(large):
                part = slice(starts[g], starts[g + 1])
                columns = n[part], comp[part], parity[part]
                yield from named(sig[part], keys[part], *columns, near_pairs(*columns, side[part], percent))
            rows = np.flatnonzero(np.repeat(~large, sizes))
            if len(rows):
                small = np.concatenate([[0], np.cumsum(sizes[~large])])
                cuts = np.searchsorted(np.cumsum(sizes[~large] ** 2), np.arange(0, int((sizes[~large] ** 2).sum()) + 1, 4_000_000), side="right")
                for first, last in zip(cuts, [*cuts[1:], len(small) - 1], strict=True):
                    if first < last:
                        part = rows[small[first] : small[last]]
                        columns = n[part], comp[part], parity[part]
                        yield from named(sig[part], keys[part], *columns, near_pairs_of_groups(small[first : last + 1] - small[first], *columns, percent))

        held: list[tuple] = []
        for batch in batches:
            sig, i, j, side, keys, n, comp = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(7))
            lists = batch.column(7)
            if not len(lists):
                continue
            parity = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
            names = np.stack([sig, i, j], axis=1)
            # The last group may go on in the next batch.
            last = len(names) - int(np.argmin((names[::-1] == names[-1]).all(axis=1))) if (names != names[-1]).any() else 0
            whole, rest = slice(0, last), slice(last, len(names))
            columns = (names, keys, n, comp, parity, side)
            if held and (held[-1][0][-1] != names[0]).any():
                yield from of_rows(held)
                held = []
            if last:
                held.append(tuple(c[whole] for c in columns))
                yield from of_rows(held)
                held = []
            held.append(tuple(c[rest] for c in columns))
        if held:
            yield from of_rows(held)
        if met:
            yield from once()

    sorted_rows = dealt.repartition("least", "share", "i", "j").sortWithinPartitions("least", "share", "sig", "i", "j").drop("least", "share")
    return sorted_rows.mapInArrow(run, "x bigint, y bigint, sig bigint")


def _open_rows(in_groups: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows for ``_pairs_across`` of the groups that lie in several components, and these groups, stored."""
    placed = many_to_one(in_groups, labels.select("k1", "comp"), ["k1"])
    several = placed.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.first("least").alias("least"), F.first("members").alias("members"))
    several = stored(several.where("lo < hi").select("sig", "least", "members"), "open")
    shares = several.groupBy("least").agg(F.ceil(F.sum("members") / F.lit(_SHARE)).alias("shares"))
    shared = many_to_one(several, shares, ["least"]).select("sig", "least", "members", F.pmod(F.xxhash64("sig"), "shares").alias("share"))
    still_open = many_to_one(in_groups.select("sig", "k1"), shared, ["sig"], "inner")
    return many_to_one(still_open, labels, ["k1"]), several


def similar_groups(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Each row's id, ``n_shingles`` and ``component_id``, the least id its links reach.

    A text without words (or null) has an empty set and is linked with nothing, one with
    fewer than ``words`` words is one element. A row with a null id is no node: it has
    the component of rows with its very set, or null. Rows with a repeated id are nodes of
    their own if their sets differ. Columns other than the two named are not read.
    """
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    members = stored(_sets(docs, words, "id", "text"), "sets")
    sets = members.where("n > 0 and id is not null").groupBy("k1", "k2")
    reps = stored(sets.agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("parity").alias("parity")), "reps")

    keyed = stored(_chosen(_signature_rows(docs, words, percent, "text")), "signatures")
    named = reps.select("k1", F.struct(F.col("rep").alias("id"), "k1").alias("node"), "n", "parity")
    nodes = stored(named.join(keyed.select("k1").distinct(), "k1"), "nodes")
    by_key = replicate_counted(nodes.select("k1", "node"))

    def by_nodes(pairs: DataFrame) -> DataFrame:
        """Pairs of keys as pairs of nodes, the lower first."""
        x, y = by_key.select(F.col("k1").alias("x"), F.col("node").alias("nx")), by_key.select(F.col("k1").alias("y"), F.col("node").alias("ny"))
        return pairs.join(x, "x").join(y, "y").where("nx != ny").select(F.least("nx", "ny").alias("a"), F.greatest("nx", "ny").alias("b"))

    groups = keyed.groupBy("sig").agg(F.min("k1").alias("least"), F.max("k1").alias("most"), F.count(F.lit(1)).alias("members")).where("least < most")
    groups = stored(groups, "groups")
    in_groups = many_to_one(keyed, groups, ["sig"], "inner")
    ends = in_groups.select(F.col("k1").alias("x"), F.explode(F.array("least", "most")).alias("y")).where("x != y").distinct()
    # Different sets with one 64-bit key, if there ever are any.
    same_key = nodes.groupBy("k1").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("k1").alias("x"), F.col("k1").alias("y"))
    tried = stored(by_nodes(ends.unionByName(same_key)).distinct(), "pairs")
    first = stored(_plausible(tried, nodes, percent), "plausible")
    links = _verified(first, docs, words, percent)
    joined = components(links, "a", "b")

    # Pairs of a forest first; then those of the groups that hold more, as far as still apart.
    done = [keyed, groups, first]
    for sparse in (True, False):
        labels = nodes.join(joined, "node", "left").select("k1", "n", "parity", F.xxhash64(F.coalesce("component", "node")).alias("comp"))
        labels = stored(labels.dropDuplicates(["k1"]), "components")
        rows, several = _open_rows(in_groups, labels)
        across = stored(_pairs_across(rows, percent, sparse), "across")
        more = stored(by_nodes(across.where("sig is null").select("x", "y").distinct()).join(tried, ["a", "b"], "left_anti"), "pairs")
        done += [labels, several, across, more]
        if more.limit(1).count():
            links = links.unionByName(_verified(more, docs, words, percent))
            joined = components(links, "a", "b")
        with_more = across.where("sig is not null").select("sig").distinct()
        if not with_more.limit(1).count():
            break
        in_groups = many_to_one(in_groups, with_more, ["sig"], "inner")
        done, tried = [*done, tried], stored(tried.unionByName(more), "pairs")
    discard(*done, tried)
    own = many_to_one(members.drop("parity"), reps.select("k1", "k2", "rep"), ["k1", "k2"])
    found = many_to_one(own, joined.select(F.col("node.id").alias("rep"), F.col("node.k1").alias("k1"), F.col("component.id").alias("component")), ["rep", "k1"])
    return found.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "id").alias("component_id"))
