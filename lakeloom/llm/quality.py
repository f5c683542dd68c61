"""Quality by weak supervision: rules vote or abstain, expectation-maximisation finds how
far to trust each, and a document is kept for its posterior probability of being good.

One pass over the texts measures them. Rules turn measures into votes; documents with equal
votes are alike to the model, so it learns from the number of documents of each pattern of
votes, counted over all documents, of which there are a bounded number however many the
documents are. A rule has two rates, how often it votes "good" on good and on bad documents:
a fault shows in few rules, and a vote for "good" by the others must not outweigh it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_WORDS = 8
#: A base rule: fewer words than this, or more than this percentage of repeated words, fail.
LEAST_WORDS, MOST_REPEATED = 20, 30

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_END = re.compile(rb"[.!?\xe2\xe3][^\x20\x09-\x0D]{0,2}(?=[\x20\x09-\x0D]|$)")
_NO_WORD = re.compile(rb"[\x20\x09-\x0D][!-/:-@\[-`{-~]+(?=[\x20\x09-\x0D]|$)")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_loud", "n_ends", "n_bare", "n_distinct")


def repeated_words(words: list[bytes], window: int = WINDOW_WORDS) -> int:
    """Words that lie in a run of ``window`` words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    runs = list(zip(*(words[i:] for i in range(window)), strict=False))
    first: dict[tuple, int] = {}
    again = []
    for i, run in enumerate(runs):
        at = first.setdefault(run, i)
        if at != i:
            again += (at, i)
    if not again:
        return 0
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.unique(np.array(again))
    covered[starts] += 1
    covered[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


def measure_text(text: str | None) -> tuple[int, ...]:
    """Measures of a whole text, in the order of ``MEASURES``; null counts as empty."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at space and the characters 9 to 13, and nowhere else
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "surrogatepass"))
    lines, seen, dup_lines, n_lines = data.split(b"\n"), set(), 0, 0
    for line in lines:
        if line.split(None, 1):
            n_lines += 1
            dup_lines += line in seen
            seen.add(line)
    letters = sum(map(str.isalpha, text)) if not text.isascii() else len(joined) - len(re.findall(rb"[^A-Za-z]", joined))
    upper = len(re.findall(r"[A-ZÀ-ÖØ-ÞΑ-ΩА-Я]", text))
    return (
        len(words), chars, len(_SYMBOLS.findall(data)), dup_lines, repeated_words(words), n_lines,
        upper, letters, data.count(b"!!"), len(_END.findall(data)), len(_NO_WORD.findall(b" " + data)), len(set(words)),
    )


def measure(docs: DataFrame, keep: Sequence[str], text_column: str = "text") -> DataFrame:
    """The columns ``keep`` and, in a struct ``_m``, the measures of each row's text. The names
    ``_m``, ``base_failed``, ``quality`` and ``kept`` are taken by this module and refused in
    ``keep``. A text that is kept travels once, and texts are measured a few hundred at a time."""
    taken = {c.lower() for c in keep} & {"_m", "base_failed", "quality", "kept"}
    if taken:
        raise ValueError(f"rename the columns {sorted(taken)}")
    fields = [docs.schema[c] for c in keep]
    inner = pa.struct([(m, pa.int64()) for m in MEASURES])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["_m struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">"])
    sent = [*keep] if text_column in keep else [text_column, *keep]
    at, first = sent.index(text_column), len(sent) - len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                found = np.array([measure_text(t.as_py()) for t in batch.column(at)], dtype=np.int64).reshape(-1, len(MEASURES))
                struct = pa.StructArray.from_arrays([pa.array(found[:, i].copy()) for i in range(len(MEASURES))], fields=list(inner))
                yield pa.RecordBatch.from_arrays([*batch.columns[first:], struct], [*keep, "_m"])

    return docs.select(*[F.col(f"`{c}`") for c in sent]).mapInArrow(run, schema)


def base_failed() -> Column:
    m = F.col("_m")
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def _votes() -> dict[str, Column]:
    """1 for good, -1 for bad, 0 for an abstention. A share lies between a bound for good
    and one for bad; between them, and where a text is too short for it, a rule abstains."""
    m = F.col("_m")
    words, lines = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["n_lines"], F.lit(1))

    def low_is_good(share: Column, good: float, bad: float, enough: Column | None = None) -> Column:
        vote = F.when(share <= good, 1).when(share >= bad, -1).otherwise(0)
        return vote if enough is None else F.when(enough, vote).otherwise(0)

    long_word = m["word_chars"] / words
    return {
        "symbols": low_is_good(m["n_symbols"] / words, 0.05, 0.25),
        "word_length": F.when((long_word >= 3) & (long_word <= 9), 1).when((long_word < 2) | (long_word > 14), -1).otherwise(0),
        "same_lines": low_is_good(m["n_dup_lines"] / lines, 0.2, 0.5, m["n_lines"] >= 4),
        "same_runs": low_is_good(m["n_repeat_words"] / words, 0.1, 0.25, m["n_words"] >= 2 * WINDOW_WORDS),
        "capitals": low_is_good(m["n_upper"] / F.greatest(m["n_letters"], F.lit(1)), 0.2, 0.4),
        "letters": low_is_good(1 - m["n_letters"] / F.greatest(m["word_chars"], F.lit(1)), 0.18, 0.28),
        "loud": low_is_good(m["n_loud"] / words, 0.02, 0.15),
        "bare_signs": low_is_good(m["n_bare"] / words, 0.04, 0.2),
        "sentences": F.when(m["n_words"] < 60, 0).otherwise(F.when(m["n_ends"] * 60 >= m["n_words"], 1).when(m["n_ends"] * 150 < m["n_words"], -1).otherwise(0)),
        "same_words": F.when(m["n_words"] < 30, 0).otherwise(
            F.when(m["n_distinct"] * 25 >= F.sqrt(m["n_words"].cast("double")) * 50, 1).when(m["n_distinct"] * 2 < F.sqrt(m["n_words"].cast("double")), -1).otherwise(0)
        ),
    }


@dataclass(frozen=True)
class Model:
    """Share of good documents, and each rule's rate of votes for good on good and bad ones."""

    share: float
    on_good: dict[str, float]
    on_bad: dict[str, float]

    def log_odds(self) -> Column:
        votes = _votes()
        total = F.lit(float(np.log(self.share / (1 - self.share))))
        for rule, vote in votes.items():
            good = float(np.log(self.on_good[rule] / self.on_bad[rule]))
            bad = float(np.log((1 - self.on_good[rule]) / (1 - self.on_bad[rule])))
            total = total + F.when(vote == 1, good).when(vote == -1, bad).otherwise(0.0)
        return total

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def learn(measured: DataFrame, rounds: int = 200) -> Model:
    """Expectation-maximisation over the patterns of votes of all measured documents.

    The rates have prior counts, so a rule that hardly votes keeps a careful rate, and a
    rule's rate on good documents is never below that on bad ones. An empty table gives
    the prior."""
    votes = _votes()
    rules = list(votes)
    counted = measured.where(~base_failed()).groupBy(*[v.cast("int").alias(r) for r, v in votes.items()]).agg(F.count(F.lit(1)).alias("_n")).collect()
    patterns = np.array([[r[k] for k in rules] for r in counted], dtype=float).reshape(-1, len(rules))
    n = np.array([r["_n"] for r in counted], dtype=float)
    share, on_good, on_bad = 0.85, np.full(len(rules), 0.995), np.full(len(rules), 0.8)
    good_votes, bad_votes = (patterns == 1).astype(float), (patterns == -1).astype(float)
    for _ in range(rounds):
        log_odds = np.log(share / (1 - share)) + good_votes @ np.log(on_good / on_bad) + bad_votes @ np.log((1 - on_good) / (1 - on_bad))
        p = 1 / (1 + np.exp(-np.clip(log_odds, -40, 40)))
        before = np.concatenate([on_good, on_bad, [share]])
        share = float(np.clip((p @ n + 8.5) / (n.sum() + 10), 0.02, 0.98))

        def rate(weight: np.ndarray, prior_good: float, prior_bad: float) -> np.ndarray:
            return (weight @ good_votes + prior_good) / (weight @ (good_votes + bad_votes) + prior_good + prior_bad)

        on_good = np.clip(rate(p * n, 9.95, 0.05), 0.5, 0.9995)
        on_bad = np.clip(np.minimum(rate((1 - p) * n, 8, 2), on_good - 1e-4), 0.02, 0.95)
        if np.abs(np.concatenate([on_good, on_bad, [share]]) - before).max() < 1e-7:
            break
    return Model(share, dict(zip(rules, on_good.tolist(), strict=True)), dict(zip(rules, on_bad.tolist(), strict=True)))


def judged(measured: DataFrame, model: Model) -> DataFrame:
    """Add ``base_failed``, ``quality`` (posterior probability of a good document) and
    ``kept``. Every row has a verdict; an empty text fails the base rule."""
    return measured.withColumns({"base_failed": base_failed(), "quality": model.posterior()}).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
