"""Document fingerprints by Order MinHash, in built-in functions only.

Words are the letters of the text's alphabet (of a word too long for one, as in writing
without spaces, its runs of characters are): its k-mers are runs of ``K`` words, numbered by
occurrence, so the second "of the" differs from the first. A hash of each numbered k-mer
places it in one of ``BINS`` bins and orders it there. A bin that holds a k-mer keeps the two
least from its start on (where it has but one, the second is the next of the bins that
follow, around the end), puts them back into text order, and hashes that tuple. So each
tuple has an order wherever the text has two k-mers. Two texts' likeness is the share of
bins, among those filled in either, whose tuples are equal: it falls when k-mers change and
also when they change places, as edit distance does.

Everything happens inside a row. Arrays of 64-bit integers hold a hash in the upper and a
place in the lower bits, so sorting them sorts by hash and then by place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, BINS = 2, 64
#: Lower bits for a place in the text. Beyond so many words places repeat, alike for equal texts.
_PLACE_BITS = 24
_PLACE = (1 << _PLACE_BITS) - 1
_BIN_BITS = BINS.bit_length() - 1
_SPACE = " \t\n\x0b\f\r"
#: A word of more bytes counts as its overlapping runs of so many characters.
_WORD_BYTES, _RUN_CHARS = 48, 4


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _packed(hashed: Column, place: Column) -> Column:
    """The hash's upper bits, without its sign, above the place."""
    return F.shiftrightunsigned(hashed, 1).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place.bitwiseAND(F.lit(_PLACE)))


def _hash(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(~_PLACE))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(_PLACE))


def _first_of_run(runs: Column, at: Column) -> Column:
    """Least index in a sorted array with the hash of index ``at``, by bisection."""
    wanted = _hash(F.get(runs, at))
    start = F.struct(F.lit(0).alias("lo"), at.alias("hi"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state["lo"] + state["hi"], 1)
        found = F.get(runs, middle) >= wanted
        return F.struct(
            F.when(found | (state["lo"] >= state["hi"]), state["lo"]).otherwise(middle + 1).alias("lo"),
            F.when(found & (state["lo"] < state["hi"]), middle).otherwise(state["hi"]).alias("hi"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(at))), start, halve)["lo"]


def _letters(words: Column) -> Column:
    """Words, with the runs of characters that start at each place in words too long."""

    def runs(word: Column) -> Column:
        of_characters = lambda c: F.transform(F.slice(c, 1, F.size(c) - (_RUN_CHARS - 1)), lambda x, i: F.concat(x, *[F.get(c, i + j) for j in range(1, _RUN_CHARS)]))
        return _let(F.split(word, ""), of_characters)

    long = lambda word: F.octet_length(word) > _WORD_BYTES
    split = F.flatten(F.transform(words, lambda word: F.when(long(word), runs(word)).otherwise(F.array(word))))
    return F.when(F.exists(words, long), split).otherwise(words)


def tuples(text: Column) -> Column:
    """Sorted array of the filled bins' tuples: the bin above, the tuple's hash below. A text
    without words (null counts as empty) fills none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{_SPACE}]+"))

    def of_words(w: Column) -> Column:
        last = F.greatest(F.size(w) - (K - 1), F.least(F.size(w), F.lit(1)))
        grams = F.transform(F.slice(w, 1, last), lambda x, i: _packed(F.xxhash64(x, *[F.get(w, i + j) for j in range(1, K)]), i.cast("long")))
        return _let(F.sort_array(grams), lambda runs: _let(_numbered(runs), _by_bin))

    return _let(words, lambda w: _let(_letters(w), of_words))


def _numbered(runs: Column) -> Column:
    """K-mers sorted by hash, where later occurrences of a k-mer get hashes of their own."""

    def number(packed: Column, i: Column) -> Column:
        again = (i > 0) & (_hash(F.get(runs, i - 1)) == _hash(packed))
        return F.when(again, _packed(F.xxhash64(_hash(packed), i - _first_of_run(runs, i)), _place(packed))).otherwise(packed)

    distinct = F.size(F.array_distinct(F.transform(runs, _hash))) == F.size(runs)
    return F.when(distinct, runs).otherwise(F.sort_array(F.transform(runs, number)))


def _bin(packed: Column) -> Column:
    return F.shiftright(packed, 63 - _BIN_BITS)


def _by_bin(ordered: Column) -> Column:
    """The tuple of each filled bin. A hash's upper bits are the bin, so the bin's first k-mer
    and the one after it, in sorted order and around its end, are the least two from the bin's
    start on; they are hashed in text order. A text's only k-mer is hashed by itself."""

    def tuple_at(first: Column, i: Column) -> Column:
        second = F.coalesce(F.get(ordered, i + 1), F.get(ordered, F.lit(0)))
        hashed = (
            F.when(F.size(ordered) == 1, F.xxhash64(_hash(first)))
            .when(_place(first) < _place(second), F.xxhash64(_hash(first), _hash(second)))
            .otherwise(F.xxhash64(_hash(second), _hash(first)))
        )
        return F.shiftleft(_bin(first), 63 - _BIN_BITS).bitwiseOR(F.shiftrightunsigned(hashed, 1 + _BIN_BITS))

    opens = F.filter(F.transform(ordered, lambda x, i: F.when((i == 0) | (_bin(F.get(ordered, i - 1)) != _bin(x)), i)), lambda i: i.isNotNull())
    return F.transform(opens, lambda i: tuple_at(F.get(ordered, i), i))


def fingerprint(found: Column) -> Column:
    """The tuples as text: sixteen hexadecimal digits for each filled bin."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    """Share of equal bins among those filled in either; two texts without words are alike."""
    either = F.size(F.array_union(F.transform(one, _bin), F.transform(other, _bin)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, other)) / either)


#: Rows that a range of neighbouring ids should hold, and most ranges.
_RANGE_ROWS, _MOST_RANGES = 1500, 1 << 14


def _range_starts(docs: DataFrame, key: str) -> tuple[list[int], object, int]:
    """Ids that exist and start ranges of about equal size, the least id, and how many rows
    have a null id. The first range starts at the least id, so no range is empty."""
    rows, nulls, lowest = docs.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull()), F.min(key)).first()
    ranges = min(rows // _RANGE_ROWS, _MOST_RANGES)
    if ranges < 2:
        return [], lowest, nulls
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.percentile_approx(key, shares, 20 * ranges).alias("q")).first()["q"] or []
    return sorted({q for q in found if q > lowest}), lowest, nulls


def _with_next(docs: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Add ``_next_<column>`` of the row that follows in ascending order of ``key`` (nulls
    first, ties by the columns); the last row is followed by the first.

    Rows are shuffled once, by range of ids. The first row of a range is also sent to the
    range before, as a ghost at its end, and the table's first to the last range."""
    starts, lowest, nulls = _range_starts(docs, key)
    id_ = F.col(key)
    at = F.lit(0)
    if starts:
        steps, listed = F.array(*[F.lit(1 << i) for i in reversed(range(len(starts).bit_length()))]), F.lit(starts)
        at = F.coalesce(F.aggregate(steps, at, lambda i, s: F.when(F.get(listed, i + s - 1) <= id_, i + s).otherwise(i)), at)
    cut = docs.withColumn("_at", at)
    opens = F.get(F.lit(starts), F.col("_at") - 1) == id_ if starts else F.lit(False)
    begins = id_.isNull() if nulls else id_ == lowest
    own = F.struct(F.col("_at").alias("range"), F.lit(False).alias("ghost"))
    before = F.when(opens, F.struct((F.col("_at") - 1).alias("range"), F.lit(True).alias("ghost")))
    around = F.when(begins, F.struct(F.lit(len(starts)).alias("range"), F.lit(True).alias("ghost")))
    placed = cut.withColumn("_to", F.explode(F.filter(F.array(own, before, around), lambda x: x.isNotNull())))
    order = Window.partitionBy("_to.range").orderBy("_to.ghost", F.asc_nulls_first(key), *columns)
    following = placed.withColumns({f"_next_{c}": F.lead(c).over(order) for c in columns})
    return following.where("not _to.ghost").drop("_at", "_to")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row's id and ``fingerprint``. Null counts as empty; other columns are not read."""
    return docs.select(id_column, fingerprint(tuples(F.col(text_column))).alias("fingerprint"))


def compare_with_edit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each text and of an edited one, whose second half is the beginning of
    the next document's text, and the text's likeness to the edited and to the next text.

    Ids are integers or null. A null text counts as empty; repeated rows follow one another."""
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    following = _with_next(rows.withColumn("own", tuples(F.col("text"))), "id", ["text", "own"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("_next_text", F.lit(1), half))
    changed = following.select("id", "own", "_next_own", n.cast("long").alias("n_chars"), edited.alias("edited"))
    made = changed.withColumn("other", tuples(F.col("edited")))
    return made.select(
        F.col("id").alias(id_column),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("_next_own")).alias("near_next"),
    )
