"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, no accents, look-alike letters and digits in words read
as the Latin letters they stand for, everything else a space. Entries are word beginnings
or whole words with weights, the log-odds of their document frequency in toxic and clean
training texts. Exception phrases are pairs of words that hold an entry and occur in clean
training texts only; a hit inside one does not count. A text's evidence is the sum of its
hits' weights over a slowly growing function of its length, and a logistic curve fitted on
the training texts turns it into a score.

The classifier learns from at most ``MOST_TRAINING`` labelled texts of each class, taken by
a hash of their id; scoring covers every row and needs no shuffle.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.storage import discard, stored

#: Labelled texts of each class to learn from.
MOST_TRAINING = 12_000
#: Word beginnings tried as entries, in letters.
PREFIXES = range(4, 10)
#: Toxic texts that an entry needs at least, and the least log-odds.
LEAST_TEXTS, LEAST_ODDS = 4, 3.0

#: Bytes of text whose features a task counts before it passes them on.
_COUNTED_AT_ONCE = 1 << 18

# Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
LOOK_ALIKE = str.maketrans(
    "абвгдеѕіјкмнорстухѵьԁԛԝһαβεηικνορτυχωı" + "0123456789",
    "abbrdesijkmhopctyxvbdqwhabenikvoptuxwi" + "oizeasbtbg",
)
_SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
#: A sign stands for a letter where one follows, and the last two only inside a word.
_SIGN_IN_WORD = re.compile(r"[@$](?=\w)|(?<=\w)[!|](?=\w)")
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_NO_LETTER = re.compile(r"[^a-z\u0080-\U0010ffff]+")


def fold(text: str) -> str:
    """Words of letters with one space before each and one at the end."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", _HIDDEN.sub("", text))
        text = "".join([c for c in text if not unicodedata.combining(c)]) if not text.isascii() else text
    if "@" in text or "$" in text or "!" in text or "|" in text:
        text = _SIGN_IN_WORD.sub(lambda m: _SIGNS[m[0]], text)
    text = text.lower().translate(LOOK_ALIKE)
    text = _NO_LETTER.sub(" ", text)
    return f" {text.strip()} "


def features(folded: str) -> set[str]:
    """Beginnings of words with a space before them, and whole words between spaces."""
    out = set()
    for word in set(folded.split()):
        out.update(" " + word[:n] for n in PREFIXES if n <= len(word))
        out.add(f" {word} ")
    return out


@dataclass(frozen=True)
class Lexicon:
    """Weighted entries, exception phrases, and the curve from evidence to score."""

    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    slope: float
    bias: float


@lru_cache(maxsize=4)
def _automaton(lexicon: Lexicon):
    import ahocorasick

    found = ahocorasick.Automaton()
    for entry, weight in lexicon.entries:
        found.add_word(entry, (len(entry), weight))
    for phrase in lexicon.exceptions:
        found.add_word(phrase, (len(phrase), None))
    if lexicon.entries:
        found.make_automaton()
    return found


def hits(folded: str, lexicon: Lexicon) -> list[float]:
    """The weight of each word that an entry matches, the heaviest entry counting; words
    inside an exception phrase are left out."""
    if not lexicon.entries:
        return []
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (length, weight) in _automaton(lexicon).iter(folded):
        start = end - length + 1
        if weight is None:
            excused.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    if not excused:
        return list(best.values())
    excused.sort()
    kept, i, reach = [], 0, -1
    # Hits and excused spans in one sweep: a hit counts if no span that has begun reaches beyond it.
    for at in sorted(best):
        while i < len(excused) and excused[i][0] <= at:
            reach = max(reach, excused[i][1])
            i += 1
        if at >= reach:
            kept.append(best[at])
    return kept


def evidence(folded: str, lexicon: Lexicon) -> float:
    total = sum(hits(folded, lexicon))
    return total / (1.0 + 0.1 * math.log1p(folded.count(" ") / 100.0)) if total else 0.0


def score_text(text: str | None, lexicon: Lexicon) -> float:
    z = lexicon.slope * evidence(fold(text or ""), lexicon) + lexicon.bias
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a logistic curve, by Newton's method with a small penalty."""
    design, w = np.stack([x, np.ones_like(x)], axis=1), np.array([0.5, -2.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + np.array([0.5, 0.05]) * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag([0.5, 0.05])
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 0.0)), float(w[1])


def _sampled(labels: DataFrame, id_column: str, label_column: str) -> DataFrame:
    """At most about ``MOST_TRAINING`` ids of each class, the same ones on every run."""
    one_each = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1)).groupBy(id_column).agg(F.max(label_column).alias("_label"))
    counts = {r["_label"]: r["n"] for r in one_each.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("train"), id_column), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(v) for k in (0, 1) for v in (k, MOST_TRAINING / max(MOST_TRAINING, counts.get(k, 1)))])
    return one_each.where(draw < F.element_at(share, F.col("_label").cast("int")))


def _counted(training: DataFrame) -> DataFrame:
    """Document frequencies of features in both classes and the toxic texts they occur in."""

    def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Rows in slices of bounded size: a text has a few features for each of its words."""
        held, size = [], 0
        for batch in batches:
            for key, text, label in zip(*batch.columns, strict=True):
                held.append((key.as_py(), text.as_py() or "", label.as_py()))
                size += len(held[-1][1])
                if size >= _COUNTED_AT_ONCE:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            toxic, clean = defaultdict(list), Counter()
            for key, text, label in rows:
                found = features(fold(text))
                if label:
                    for f in found:
                        toxic[f].append(key)
                else:
                    clean.update(found)
            names = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([toxic.get(n, []) for n in names], pa.list_(pa.int64())), pa.array([clean[n] for n in names], pa.int64())],
                ["feature", "texts", "clean"],
            )

    return (
        training.select(F.xxhash64("text").alias("key"), "text", "_label")
        .mapInArrow(count, "feature string, texts array<bigint>, clean bigint")
        .groupBy("feature")
        .agg(F.array_distinct(F.flatten(F.collect_list("texts"))).alias("texts"), F.sum("clean").alias("clean"))
        .withColumn("toxic", F.size("texts"))
    )


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Lexicon:
    """A lexicon from labelled texts. ``labels`` holds ids and a label of 0 or 1; an id with
    several counts as toxic if one says so, null ids and labels are left out. Without toxic
    or clean texts the lexicon is empty and every score is low."""
    chosen = F.broadcast(_sampled(labels, id_column, label_column))  # at most about twice MOST_TRAINING rows
    training = docs.select(id_column, F.col(text_column).alias("text")).join(chosen, id_column).select("text", "_label").dropDuplicates()
    training = stored(training, "training")
    try:
        sizes = {r["_label"]: r["n"] for r in training.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
        n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
        if not n_toxic or not n_clean:
            return Lexicon((), (), 1.0, -4.0)
        odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
        candidates = (
            _counted(training).withColumn("odds", odds).where((F.col("toxic") >= LEAST_TEXTS) & (F.col("odds") >= LEAST_ODDS)).drop("clean")
        )
        # Features of the very same toxic texts explain the same: one of them stands for all,
        # so words of a text that was copied often are one candidate. What reaches the driver
        # is bounded by the training texts, places in them packed as four-byte numbers.
        alike = candidates.groupBy(F.xxhash64(F.sort_array("texts"))).agg(F.max(F.struct("odds", F.length("feature").alias("_length"), "feature", "texts")).alias("c"))
        places: dict[int, int] = {}
        entries = _cover(
            [(r.c.feature, np.array([places.setdefault(t, len(places)) for t in r.c.texts], dtype=np.int32), float(r.c.odds)) for r in alike.toLocalIterator()], n_toxic
        )
        draft = Lexicon(tuple(entries), (), 1.0, -4.0)
        exceptions = _exceptions(training, draft)
        draft = Lexicon(draft.entries, tuple(exceptions), 1.0, -4.0)

        def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([evidence(fold(t or ""), draft) for t in batch.column(0).to_pylist()], pa.float64()), batch.column(1).cast(pa.float64())],
                    ["x", "y"],
                )

        pairs = training.select("text", "_label").mapInArrow(weigh, "x double, y double").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).collect()
        x, y, n = (np.array([r[i] for r in pairs], dtype=float) for i in range(3))
        slope, bias = _fit_curve(np.repeat(x, n.astype(int)), np.repeat(y, n.astype(int)))
        return Lexicon(draft.entries, draft.exceptions, slope, bias)
    finally:
        discard(training)


def _cover(candidates: Sequence[tuple[str, np.ndarray, float]], n_toxic: int) -> list[tuple[str, float]]:
    """Entries that explain toxic texts: again and again the one that occurs in most texts
    without an entry, the longer of equals, then frequent ones that no entry begins. Words
    that only come along in copies of a toxic text explain nothing new and stay out.

    ``candidates`` are features with the numbers of their texts and their log-odds. What a
    candidate adds only falls, so a heap of what it added when last looked at is enough."""
    size = 1 + max((int(texts.max()) for _, texts, _ in candidates if len(texts)), default=-1)
    left = np.ones(size, dtype=bool)
    in_order = sorted(candidates, key=lambda c: (len(c[0]), c[0]), reverse=True)
    heap = [(-len(texts), place) for place, (_, texts, _) in enumerate(in_order)]
    heapq.heapify(heap)
    chosen: dict[str, float] = {}
    while heap:
        gain, place = heap[0]
        feature, texts, odds = in_order[place]
        now = int(left[texts].sum())
        if now < -gain:
            heapq.heapreplace(heap, (-now, place))
            continue
        if now < LEAST_TEXTS:
            break
        heapq.heappop(heap)
        chosen[feature] = odds
        left[texts] = False
    begins = set(chosen)
    for _, place in heap:
        feature, texts, odds = in_order[place]
        if len(texts) >= max(2 * LEAST_TEXTS, 0.01 * n_toxic) and odds >= LEAST_ODDS + 2 and not any(feature[:n] in begins for n in range(1, len(feature) + 1)):
            chosen[feature] = odds
    return sorted(chosen.items())


def _exceptions(training: DataFrame, lexicon: Lexicon) -> list[str]:
    """Two-word phrases around a hit that occur in clean texts only, several times."""
    if not lexicon.entries:
        return []

    def phrases(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                folded, here = fold(text or ""), set()
                for end, (length, _) in _automaton(lexicon).iter(folded):
                    start = end - length + 1
                    stop = folded.index(" ", start + 1)
                    before = folded.rfind(" ", 0, start)
                    after = folded.find(" ", stop + 1)
                    if before >= 0:
                        here.add(folded[before : stop + 1])
                    if after >= 0:
                        here.add(folded[start : after + 1])
                for p in here:
                    found[p][label] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), *(pa.array([v[i] for v in found.values()], pa.int64()) for i in (0, 1))], ["phrase", "clean", "toxic"]
            )

    counted = training.select("text", F.col("_label").cast("int")).mapInArrow(phrases, "phrase string, clean bigint, toxic bigint").groupBy("phrase")
    kept = counted.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where((F.col("toxic") == 0) & (F.col("clean") >= LEAST_TEXTS))
    # No more than words of the training texts.
    return sorted(r.phrase for r in kept.select("phrase").collect())


def score(docs: DataFrame, lexicon: Lexicon, keep: Sequence[str], text_column: str = "text", name: str = "score") -> DataFrame:
    """The columns ``keep`` and the score of each row's whole text, as column ``name``, which
    ``keep`` must not hold, in one pass without a shuffle. A null or empty text gets the
    score of no evidence. A text that is kept travels once."""
    if name.lower() in {c.lower() for c in keep}:
        raise ValueError(f"there is a column {name} already; give another name for the score")
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{name}` double"])
    sent = [*keep] if text_column in keep else [text_column, *keep]
    at, first = sent.index(text_column), len(sent) - len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                scores = [score_text(t.as_py(), lexicon) for t in batch.column(at)]
                yield pa.RecordBatch.from_arrays([*batch.columns[first:], pa.array(scores, pa.float64())], [*keep, name])

    return docs.select(*[F.col(f"`{c}`") for c in sent]).mapInArrow(run, schema)
