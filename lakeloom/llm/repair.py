"""Repair of conversation structure by weighted interval parsing.

Rows of a conversation are kept, given another role, deleted, or empty turns are inserted,
until their roles follow an order that a finite automaton describes. The repair grammar in
Chomsky normal form has one nonterminal for each pair of states (p, q), "this span leads
from p to q", with the rules (p, q) -> (p, r) (r, q), and a row's edits as terminals, closed
under insertions before and after. A cell of a span holds for each nonterminal the least
(cost, audit), the audit being the initials of its edits. Cells are combined bottom-up by
span length.

Every state of the automaton is an r of the rules, so each way to cut a span finds the same
cell, and one cut a span is enough: spans of 1, 2, 4, ... rows, a number of combinations
that is linear in the rows. Of two audits of equal cost for one span and one nonterminal
neither begins with the other (both treat the same rows, so the longer one has insertions
more and costs more), hence the lesser stays the lesser whatever follows, and the least
parts make the least whole.

Rows are placed by ranges of conversation and turn, so a very long conversation lies in many
tasks, each parsing its own span. What meets in one task is a conversation's cells, some
letters a row, and, as a stream, its rows for the digest of the repaired text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakeloom.llm.storage import stored
from lakeloom.operators.layout import many_to_one

#: White space by the definition of a blank row.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
FAULTS = CLEAN, BLANK, DUPLICATE, TRUNCATED = ("", "blank", "duplicate", "truncated")
_ROW_BITS = 33

#: Least (cost, audit) of each pair of states that a span can lead through.
Cell = dict[tuple[int, int], tuple[int, str]]


@dataclass(frozen=True)
class Grammar:
    """Legal orders of role initials, ``(s?(ua)+)?`` unless said otherwise, and what edits cost.
    State 0 is the start. ``roles`` are those that an edit can give."""

    moves: Mapping[tuple[int, str], int] = field(default_factory=lambda: {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2})
    accepting: frozenset[int] = frozenset({0, 3})
    roles: tuple[str, ...] = ("user", "assistant")
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    left_truncated: int = 5

    @cached_property
    def legal_pairs(self) -> frozenset[str]:
        """Initials that may follow one another."""
        return frozenset(a + b for (_, a), state in self.moves.items() for (then, b) in self.moves if then == state)

    @cached_property
    def _states(self) -> list[int]:
        return sorted({0, *(p for p, _ in self.moves), *self.moves.values()})

    @cached_property
    def _given(self) -> list[tuple[int, int]]:
        """Moves by a role that an edit can give."""
        return sorted({(p, q) for (p, initial), q in self.moves.items() if initial in {r[0] for r in self.roles}})

    def role_given(self, state: int) -> tuple[str, int]:
        """The role that an edit gives in a state, and the state it leads to."""
        for role in self.roles:
            if (state, role[0]) in self.moves:
                return role, self.moves[state, role[0]]
        raise ValueError(f"no role can be given in state {state}")

    def combine(self, left: Cell, right: Cell) -> Cell:
        """(p, q) -> (p, r) (r, q), the least of all r."""
        out: Cell = {}
        for (p, r), (cost, audit) in left.items():
            for q in self._states:
                found = right.get((r, q))
                if found is None:
                    continue
                total, best = cost + found[0], out.get((p, q))
                if best is None or total < best[0]:
                    out[p, q] = (total, audit + found[1])
                elif total == best[0]:
                    out[p, q] = min(best, (total, audit + found[1]))
        return out

    @cached_property
    def closure(self) -> Cell:
        """An empty span with any insertions: as many as there are states reach whatever they can."""
        one = {(p, p): (0, "") for p in self._states}
        for p, q in self._given:
            one[p, q] = min(one.get((p, q), (self.insert, INSERT)), (self.insert, INSERT))
        out = one
        for _ in self._states:
            out = self.combine(out, one)
        return out

    @cached_property
    def _leaves(self) -> dict[tuple[str, str], Cell]:
        return {}

    def leaf(self, fault: str, initial: str) -> Cell:
        """A span of one row."""
        found = self._leaves.get((fault, initial))
        if found is None:
            row: Cell = {(p, p): (self.delete, DELETE) for p in self._states}
            if fault not in (BLANK, DUPLICATE):
                more = self.left_truncated if fault == TRUNCATED else 0
                edits = [(p, q, self.rerole + more, REROLE) for p, q in self._given]
                edits += [(p, q, self.keep + more, KEEP) for (p, name), q in self.moves.items() if name == initial]
                for p, q, cost, letter in edits:
                    row[p, q] = min(row.get((p, q), (cost, letter)), (cost, letter))
            found = self.combine(self.combine(self.closure, row), self.closure)
            if len(self._leaves) < 1000:
                self._leaves[fault, initial] = found
        return found

    def best(self, cell: Cell) -> tuple[int, int]:
        """The pair of states of the cheapest legal repair."""
        return 0, min((cell[0, q], q) for q in self.accepting if (0, q) in cell)[1]


GRAMMAR = Grammar()


class Spans:
    """Cells of the rows so far, in spans whose lengths are powers of two, longest first."""

    def __init__(self, grammar: Grammar):
        self._grammar, self._held = grammar, []

    def add(self, cell: Cell) -> None:
        length = 1
        while self._held and self._held[-1][0] == length:
            cell, length = self._grammar.combine(self._held.pop()[1], cell), 2 * length
        self._held.append((length, cell))

    def whole(self) -> Cell:
        cell = self._held[-1][1]
        for _, left in reversed(self._held[:-1]):
            cell = self._grammar.combine(left, cell)
        return cell


def pieces(grammar: Grammar, cells: list[Cell]) -> tuple[int, list[str]]:
    """The cheapest repair of adjacent spans: its cost and each span's part of the audit."""
    levels = [cells]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([grammar.combine(*below[i : i + 2]) if i + 1 < len(below) else below[i] for i in range(0, len(below), 2)])
    top = levels[-1][0]
    chosen = [grammar.best(top)]
    cost = top[chosen[0]][0]
    for below in reversed(levels[:-1]):
        parts = []
        for i, (p, q) in enumerate(chosen):
            if 2 * i + 1 < len(below):
                left, right = below[2 * i : 2 * i + 2]
                r = min(((left[p, r][0] + right[r, q][0], left[p, r][1] + right[r, q][1]), r) for s, r in left if s == p and (r, q) in right)[1]
                parts += [(p, r), (r, q)]
            else:
                parts.append((p, q))
        chosen = parts
    return cost, [cell[pair][1] for cell, pair in zip(cells, chosen, strict=True)]


def _runs(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """Rows of a sorted stream."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            yield from zip(*(batch.column(i).slice(start, 1000).to_pylist() for i in range(width)), strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str)) + 64
        if size > 4 << 20:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _placed(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows in order: ``_at`` grows with (conversation, turn, role, text), its upper bits are
    the range. ``_same`` is equal where conversation, role and text are."""
    rows = conversations.select(F.col(key).alias("_conv"), F.col(turn).cast("bigint").alias("_turn"), F.coalesce(role, F.lit(" ")).alias("_role"), F.coalesce(text, F.lit(" ")).alias("_text"))
    order = [F.asc_nulls_first("_conv"), F.asc_nulls_first("_turn"), F.asc("_role")]
    named = F.concat_ws(":", F.col("_conv").isNull().cast("string"), F.coalesce(F.col("_conv").cast("string"), F.lit("")), F.char_length("_role").cast("string"), "_role", "_text")
    # Texts stay out of the sample that finds the ranges.
    ranged = rows.repartitionByRange(F.asc_nulls_first("_conv"), F.asc_nulls_first("_turn"), F.substring("_role", 1, 16)).sortWithinPartitions(*order, F.asc("_text"))
    return stored(ranged.withColumns({"_at": F.monotonically_increasing_id(), "_same": F.sha2(named, 256)}), "turns")


def _faulty(placed: DataFrame) -> DataFrame:
    """Conversation, range, place, fault and role initial of every row, without its text."""
    first = placed.groupBy("_same").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    bare = F.rtrim(F.col("_text"), F.lit(SPACE))
    own = placed.select("_conv", "_at", "_same", F.substring("_role", 1, 1).alias("_initial"), F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(CLEAN).alias("_own"))
    fault = F.when(F.col("_own") == BLANK, BLANK).when(F.col("_at") > F.col("_first"), DUPLICATE).otherwise(F.col("_own"))
    return many_to_one(own, first, ["_same"]).select("_conv", F.shiftright("_at", _ROW_BITS).alias("_part"), "_at", fault.alias("_fault"), "_initial")


def _span_cells(rows: DataFrame, grammar: Grammar) -> DataFrame:
    """One row for each conversation and range: its cell, numbers of faults and of illegal
    neighbours, and the initials at its ends."""
    kind, numbers = rows.schema["_conv"].dataType, pa.list_(pa.int64())
    types = [to_arrow_type(kind), pa.int64(), numbers, numbers, numbers, pa.list_(pa.string()), *[pa.int64()] * 4, pa.string(), pa.string()]
    names = ["_conv", "_part", "p", "q", "cost", "audit", "blank", "duplicate", "truncated", "illegal", "head", "tail"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans() -> Iterator[tuple]:
            current, held = None, None
            for conv, part, _, fault, initial in _runs(batches, 5):
                if held is None or (conv, part) != current:
                    if held is not None:
                        yield done(current, held)
                    current, held = (conv, part), [Spans(grammar), 0, 0, 0, 0, initial, None]
                elif held[6] + initial not in grammar.legal_pairs:
                    held[4] += 1
                held[0].add(grammar.leaf(fault, initial))
                if fault:
                    held[FAULTS.index(fault)] += 1
                held[6] = initial
            if held is not None:
                yield done(current, held)

        def done(current: tuple, held: list) -> tuple:
            cell = held[0].whole()
            return *current, [p for p, _ in cell], [q for _, q in cell], [c for c, _ in cell.values()], [a for _, a in cell.values()], *held[1:]

        yield from _in_batches(spans(), pa.schema(list(zip(names, types, strict=True))))

    schema = f"_conv {kind.simpleString()}, _part bigint, p array<bigint>, q array<bigint>, cost array<bigint>, audit array<string>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, tail string"
    return rows.repartition("_conv", "_part").sortWithinPartitions("_conv", "_part", "_at").mapInArrow(run, schema)


def _chosen(spans: DataFrame, grammar: Grammar) -> DataFrame:
    """Each span's part of the audit, with numbers that add up to its conversation's."""
    kind = spans.schema["_conv"].dataType
    types = [("_conv", to_arrow_type(kind)), ("_part", pa.int64()), ("_text", pa.string()), ("_numbers", pa.list_(pa.int64()))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversation(rows: list[tuple]) -> Iterator[tuple]:
            cells = [dict(zip(zip(r[2], r[3], strict=True), zip(r[4], r[5], strict=True), strict=True)) for r in rows]
            cost, audits = pieces(grammar, cells)
            tail = None
            for row, audit in zip(rows, audits, strict=True):
                met = tail is not None and tail + row[10] not in grammar.legal_pairs
                yield row[0], row[1], audit, [cost, *row[6:9], row[9] + met]
                cost, tail = 0, row[11]

        def all_pieces() -> Iterator[tuple]:
            held: list[tuple] = []
            for row in _runs(batches, 12):
                if held and held[0][0] != row[0]:
                    yield from conversation(held)
                    held = []
                held.append(row)
            if held:
                yield from conversation(held)

        yield from _in_batches(all_pieces(), pa.schema(types))

    return spans.repartition("_conv").sortWithinPartitions("_conv", "_part").mapInArrow(run, f"_conv {kind.simpleString()}, _part bigint, _text string, _numbers array<bigint>")


class _Repaired:
    """A conversation's rows as they stream by, and the digest of what the audit makes of them."""

    def __init__(self, grammar: Grammar):
        self._grammar, self._state, self._lines = grammar, 0, 0
        self._digest, self._piece, self._place = hashlib.sha256(), "", 0
        self.audit: list[str] = []
        self.numbers = [0] * 5
        self._turns, self._least, self._most = 0, None, None

    def _line(self, role: str, text: str) -> None:
        self._digest.update(f"{chr(10) if self._lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self._lines += 1

    def _insertions(self) -> None:
        while self._piece[self._place : self._place + 1] == INSERT:
            role, self._state = self._grammar.role_given(self._state)
            self._line(role, "")
            self._place += 1

    def span(self, audit: str, numbers: list[int]) -> None:
        self._insertions()
        self._piece, self._place = audit, 0
        self.audit.append(audit)
        self.numbers = [a + b for a, b in zip(self.numbers, numbers, strict=True)]

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self._most:
            self._turns, self._most = self._turns + 1, turn
            self._least = turn if self._least is None else self._least
        self._insertions()
        edit = self._piece[self._place]
        self._place += 1
        if edit == KEEP:
            self._state = self._grammar.moves[self._state, role[:1]]
            self._line(role, text)
        elif edit == REROLE:
            role, self._state = self._grammar.role_given(self._state)
            self._line(role, text)

    def result(self) -> tuple:
        self._insertions()
        gaps = 0 if self._most is None else self._most - self._least + 1 - self._turns
        cost, blank, duplicate, truncated, illegal = self.numbers
        return gaps, blank, duplicate, truncated, illegal, cost, "".join(self.audit), self._digest.hexdigest()


def repair(
    conversations: DataFrame, grammar: Grammar = GRAMMAR, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each conversation with its faults and cheapest repair: ``gaps`` (turns
    missing between its first and last), rows that are ``blank``, ``duplicate`` or
    ``truncated`` (the first of these that holds), ``illegal`` (neighbours whose role
    initials may not follow one another), ``cost``, ``audit`` (initials of the edits in
    order, the least of equal cost) and ``repaired_sha256`` (of its lines ``role:text``).

    Rows go by turn, nulls first, ties by role and text; repeated rows are duplicates. A null
    role or text is one space, so such a text is blank. Rows with a null id form one
    conversation. Other columns are not read, and an empty table gives no rows. Each role
    that edits can give must have its own state to be given in.
    """
    placed = _placed(conversations, key, turn, role, text)
    kind = placed.schema["_conv"].dataType
    found = stored(_chosen(_span_cells(_faulty(placed), grammar), grammar), "repairs")
    rows = placed.select("_conv", F.shiftright("_at", _ROW_BITS).alias("_part"), "_at", "_turn", "_role", "_text", F.lit(None).cast("array<bigint>").alias("_numbers"))
    parts = found.select("_conv", "_part", F.lit(-1).cast("bigint").alias("_at"), F.lit(None).cast("bigint").alias("_turn"), F.lit(None).cast("string").alias("_role"), "_text", "_numbers")
    names = [key, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [to_arrow_type(kind), *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            current, held = None, None
            for conv, _, _, turn_, role_, text_, numbers in _runs(batches, 7):
                if held is None or conv != current:
                    if held is not None:
                        yield current, *held.result()
                    current, held = conv, _Repaired(grammar)
                if numbers is not None:
                    held.span(text_, numbers)
                else:
                    held.row(turn_, role_, text_)
            if held is not None:
                yield current, *held.result()

        yield from _in_batches(results(), pa.schema(list(zip(names, types, strict=True))))

    sorted_rows = rows.unionByName(parts).repartition("_conv").sortWithinPartitions("_conv", "_part", "_at")
    schema = f"`{key}` {kind.simpleString()}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    return sorted_rows.mapInArrow(run, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of ``conv_id``, ``turn``, ``role`` and ``text`` as a faulty collector would deliver
    them: a hash of conversation and turn drops some, empties, cuts, repeats or gives a wrong
    role to others. Nulls of role and text, and of either id in the hash, are one space."""
    space = F.lit(" ")
    fate = F.pmod(F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))), F.lit(20))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), fate.alias("_fate")).where("_fate != 0")
    text = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fate") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")
