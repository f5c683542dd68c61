"""Conversation repair: cells against all splits, audits against all edit scripts, whole results
against a plain forward search, long conversations in many spans."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm import repair
from lakeloom.llm.repair import BLANK, CLEAN, DUPLICATE, GRAMMAR, TRUNCATED

LEGAL = re.compile("(s?(ua)+)?")


def edits_of(fault, initial):
    """Letter, cost and resulting initials of every edit of one row."""
    yield "D", 2, ""
    if fault not in (BLANK, DUPLICATE):
        more = 5 if fault == TRUNCATED else 0
        yield "K", more, initial
        for given_ in "ua":
            yield "R", 1 + more, given_


def by_all_scripts(rows, most_inserted=3):
    """Least (cost, audit) over all edit scripts with up to so many insertions at a place."""
    gaps = [("I" * n, 5 * n, "".join(p)) for n in range(most_inserted + 1) for p in itertools.product("ua", repeat=n)]
    found = []
    for choice in itertools.product(*(part for row in rows for part in (gaps, list(edits_of(*row)))), gaps):
        if LEGAL.fullmatch("".join(c[2] for c in choice)):
            found.append((sum(c[1] for c in choice), "".join(c[0] for c in choice)))
    return min(found)


def forward(rows):
    """The same by a search from the first row to the last, with the repaired roles."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit, roles) in list(best.items()):
                for x in "ua":
                    if (state, x) in moves:
                        new = (cost + 5, audit + "I", (*roles, (x, None)))
                        best[moves[state, x]] = min(best.get(moves[state, x], new), new, key=lambda v: v[:2])
        return best

    best = inserted({"": (0, "", ())})
    for i, row in enumerate(rows):
        after = {}
        for state, (cost, audit, roles) in best.items():
            for letter, price, x in edits_of(*row):
                if x and (state, x) not in moves:
                    continue
                new = (cost + price, audit + letter, (*roles, (None if letter == "K" else x, i)) if x else roles)
                to = moves[state, x] if x else state
                after[to] = min(after.get(to, new), new, key=lambda v: v[:2])
        best = inserted(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda v: v[:2])


ROW = st.tuples(st.sampled_from([CLEAN, CLEAN, BLANK, DUPLICATE, TRUNCATED]), st.sampled_from("suatx "))


@settings(max_examples=40, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=2))
def test_cells_against_all_edit_scripts(rows):
    cost, audits = repair.pieces(GRAMMAR, [GRAMMAR.leaf(*r) for r in rows])
    assert (cost, "".join(audits)) == by_all_scripts(rows) == forward(rows)[:2]


@settings(max_examples=150, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=12), st.integers(1, 5))
def test_every_split_finds_the_same_cell(rows, width):
    @lru_cache(maxsize=None)
    def all_splits(i, j):
        if j == i + 1:
            return tuple(GRAMMAR.leaf(*rows[i]).items())
        out = {}
        for k in range(i + 1, j):
            for pair, value in GRAMMAR.combine(dict(all_splits(i, k)), dict(all_splits(k, j))).items():
                out[pair] = min(out.get(pair, value), value)
        return tuple(out.items())

    spans = repair.Spans(GRAMMAR)
    for row in rows:
        spans.add(GRAMMAR.leaf(*row))
    assert spans.whole() == dict(all_splits(0, len(rows)))
    cost, audits = repair.pieces(GRAMMAR, [GRAMMAR.leaf(*r) for r in rows])
    assert (cost, "".join(audits)) == forward(rows)[:2]
    cells = []
    for i in range(0, len(rows), width):
        part = repair.Spans(GRAMMAR)
        for row in rows[i : i + width]:
            part.add(GRAMMAR.leaf(*row))
        cells.append(part.whole())
    assert repair.pieces(GRAMMAR, cells)[0] == cost and "".join(repair.pieces(GRAMMAR, cells)[1]) == "".join(audits)


def want(rows):
    """One conversation's result from its (turn, role, text) rows."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = BLANK if not bare else DUPLICATE if (role, text) in seen else TRUNCATED if bare[-1] not in ".!?" else CLEAN
        seen.add((role, text))
        faults.append(fault)
    initials = [role[:1] for _, role, _ in rows]
    cost, audit, roles = forward(list(zip(faults, initials, strict=True)))
    names = {"u": "user", "a": "assistant"}
    lines = [f"{rows[i][1] if x is None else names[x]}:{'' if i is None else rows[i][2]}" for x, i in roles]
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return gaps, *(faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


COLUMNS = "conv_id bigint, turn bigint, role string, text string, cost string, audit int"


def repaired(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS)
    return {r[0]: tuple(r)[1:] for r in repair.repair(frame).collect()}


ODD = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Hello!"),
    (2, 0, "user", "a"), (2, 5, "user", "a"), (2, 3, None, None), (2, None, "assistant", "Yes. "), (2, None, "", "No."),
    (None, 0, "user", "Lost."), (None, 0, "user", "Lost."), (None, None, None, "\t\n"),
    (3, None, "system", " "), (4, 2, "unknown", "Kept."), (4, 3, "Assistant", "Not an initial a."), (5, 1, "assistant", "x" * 300_000 + "."),
    (6, 0, "user", "é "), (6, 0, "user", "é "), (6, 1, "tool", "."), (6, 1, "assistant", "."), (7, -5, "user", "A."), (7, 5, "assistant", "B."),
]


def test_odd_rows(spark):
    by_conv = defaultdict(list)
    for conv, *row in ODD:
        by_conv[conv].append(tuple(row))
    assert repaired(spark, ODD) == {conv: want(rows) for conv, rows in by_conv.items()}
    assert repaired(spark, []) == {}


def test_long_conversations_lie_in_many_spans(spark):
    rng = random.Random(3)
    texts = ["Yes.", "No!", "cut", "", "Why?"] + [f"Turn {i}." for i in range(400)]
    rows = [(1, i, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]), rng.choice(texts)) for i in range(4000)]
    rows += [(c, i, ("user", "assistant")[i % 2], f"Said {i}.") for c in (0, 2) for i in range(40)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    coalescing = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalescing, "false")
    try:
        cells = repair._span_cells(repair._faulty(repair._placed(frame, "conv_id", "turn", "role", "text")), GRAMMAR)
        assert cells.where("_conv = 1").count() > 4
        found = repair.repair(frame).collect()
    finally:
        spark.conf.set(coalescing, "true")
    by_conv = defaultdict(list)
    for conv, *row in rows:
        by_conv[conv].append(tuple(row))
    assert {r[0]: tuple(r)[1:] for r in found} == {conv: want(v) for conv, v in by_conv.items()}


def damaged(rows):
    """The damage of the query, row by row."""
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        if fate:
            yield from [(conv, turn, role, text)] * (2 if fate == 3 else 1)


@pytest.mark.parametrize("extra", [[], [(None, None, None, None), (None, 7, "user", None), (10**6, 3, "user", "Only.")]])
def test_query_over_small_tables(spark, tables, tmp_path, extra):
    from lakeloom.llm.queries import QUERIES

    folder, conversations = tables.root, tables.conversations
    if extra:
        more = spark.createDataFrame(extra, "conv_id bigint, turn bigint, role string, text string")
        conversations.select("conv_id", "turn", "role", "text").unionByName(more).write.parquet(f"{tmp_path}/conversations.parquet")
        folder, conversations = str(tmp_path), spark.read.parquet(f"{tmp_path}/conversations.parquet")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    by_conv = defaultdict(list)
    for conv, *row in damaged(rows):
        by_conv[conv].append(tuple(row))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    wanted = {conv: want(by_conv[conv]) if by_conv[conv] else nothing for conv in {r[0] for r in rows}}
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = QUERIES["op13_repair"](spark, folder).select("conv_id", *names).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == wanted and len(found) == len(wanted)
