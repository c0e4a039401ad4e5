"""Repair of conversations: a cheapest path through the lattice of edits, found by Dijkstra's search from both ends.

A repaired conversation has the roles system, user, assistant in the order ``(s?(ua)+)?`` of their first letters. A
node of the lattice is (rows read, last role written). Rows are kept, reroled, deleted; empty rows of user or
assistant are inserted before them. Of all cheapest paths that with the ASCII-least string of edits is taken.

*Segments.* The rows of a conversation are numbered without a task for a whole conversation and cut into segments
of ``SEGMENT`` rows. Each segment is searched for each pair of roles at its ends that can occur, by two heaps that
meet; a path of a segment ends in a row, not in an insertion, so that every path through the conversation is cut in
one way. No string of edits that leads to one role is then the beginning of one that leads to another, and the rank of the
strings so far decides ties; joining segments needs four costs and four ranks.

*Rows.* The segments' paths and the rows go to one partition for each conversation, sorted, the paths
first. One pass joins the paths and applies the edits to the stream of rows, with a running SHA-256. A digest
of a whole conversation is a sequence by nature, so one conversation is one stream; it is never held.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fitledger.operators.ordered import with_row_number
from fitledger.session import saved_table

SEGMENT = 512
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5
# Last role written: nothing yet, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WRITTEN = {USER: "user", ASSISTANT: "assistant"}
# What a conversation still needs after its last row.
CLOSING = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
LAWFUL = {"su", "ua", "au"}
# A row's code: its fault where it must go, else its role's first letter, as a capital where it is truncated.
BLANK, DUPLICATE, OTHER = "b", "d", "o"


# ---- the lattice of one segment

def _row_edits(code: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, next state) for a row in this state."""
    yield "D", DELETE, state
    if code in (BLANK, DUPLICATE):
        return
    letter, more = code.lower(), TRUNCATED if code.isupper() else 0
    if (state, letter) in NEXT:
        yield "K", KEEP + more, NEXT[state, letter]
    for wanted in "ua":
        if (state, wanted) in NEXT:
            yield "R", REROLE + more, NEXT[state, wanted]


def _insertions(state: int) -> Iterator[tuple[str, int, int]]:
    for wanted in "ua":
        if (state, wanted) in NEXT:
            yield "I", INSERT, NEXT[state, wanted]


@lru_cache(maxsize=None)
def _forward(code: str) -> tuple[tuple, ...]:
    """For each state the steps (edit, cost, rows read, next state) of a node before a row of this code."""
    return tuple((*((e, c, 1, t) for e, c, t in _row_edits(code, s)), *((e, c, 0, t) for e, c, t in _insertions(s)))
                 for s in range(4))


@lru_cache(maxsize=None)
def _backward(code: str) -> tuple[tuple[tuple, ...], tuple[tuple, ...]]:
    """For each state the steps that lead there: those that read a row of this code, and the insertions before it."""
    reading = tuple(tuple((e, c, s) for s in range(4) for e, c, t in _row_edits(code, s) if t == to) for to in range(4))
    writing = tuple(tuple((e, c, s) for s in range(4) for e, c, t in _insertions(s) if t == to) for to in range(4))
    return reading, writing


@lru_cache(maxsize=1 << 15)
def cheapest(codes: str, entry: int, end: int) -> tuple[int, str] | None:
    """The least (cost, edits) from ``entry`` to ``end`` over all rows; the last edit reads a row.

    Both heaps hold (cost, edits, node), so a node is settled with its least string. A path is complete
    where a settled node of one side steps to a settled one of the other. All crossings of the least cost are looked at: the
    search ends when the two least open costs together exceed it.
    """
    n = len(codes)
    if n == 0:
        return (0, "") if entry == end else None
    ahead, behind = [(0, "", 0, entry)], [(0, "", n, end)]
    first: dict[tuple[int, int], tuple[int, str]] = {}
    last: dict[tuple[int, int], tuple[int, str]] = {}
    best: tuple[int, str] | None = None

    def cross(node: tuple[int, int], edit: str, cost: int, to: tuple[int, int]) -> None:
        nonlocal best
        (before, left), (after, right) = first[node], last[to]
        total = before + cost + after
        if best is None or total <= best[0]:
            found = (total, left + edit + right)
            best = found if best is None else min(best, found)

    while ahead and behind and (best is None or ahead[0][0] + behind[0][0] <= best[0]):
        if (len(ahead), ahead[0][0]) <= (len(behind), behind[0][0]):
            cost, edits, i, state = heapq.heappop(ahead)
            if (i, state) in first or i == n:
                continue
            first[i, state] = cost, edits
            for edit, price, read, to in _forward(codes[i])[state]:
                target = (i + read, to)
                if target in last:
                    cross((i, state), edit, price, target)
                if target not in first:
                    heapq.heappush(ahead, (cost + price, edits + edit, *target))
        else:
            cost, edits, i, state = heapq.heappop(behind)
            if (i, state) in last:
                continue
            last[i, state] = cost, edits
            steps = [(*step, i - 1) for step in _backward(codes[i - 1])[0][state]] if i else []
            if i < n:
                steps += [(*step, i) for step in _backward(codes[i])[1][state]]
            for edit, price, came, row in steps:
                source = (row, came)
                if source in first:
                    cross(source, edit, price, (i, state))
                if source not in last:
                    heapq.heappush(behind, (cost + price, edit + edits, *source))
    return best


def segment_paths(codes: str, opening: bool) -> list[tuple[int, int, int, str]]:
    """(entry, end, cost, edits) of a segment; the opening one is entered with nothing written only."""
    found = []
    for entry in (START,) if opening else range(4):
        for end in range(4):
            path = cheapest(codes, entry, end)
            if path is not None:
                found.append((entry, end, *path))
    return found


class Joined:
    """The cheapest paths through the segments so far: for each last role (cost, rank, edits as a chain)."""

    def __init__(self):
        self.live = {START: (0, 0, None)}
        self.counts, self.illegal, self.last = [0, 0, 0], 0, ""

    def add(self, codes: str, letters: str, paths: list[tuple[int, int, int, str]]) -> None:
        reached: dict[int, tuple] = {}
        for entry, end, cost, edits in paths:
            if entry in self.live:
                before, rank, chain = self.live[entry]
                option = (before + cost, rank, edits, chain)
                if end not in reached or option[:3] < reached[end][:3]:
                    reached[end] = option
        order = sorted(reached, key=lambda end: reached[end][1:3])
        self.live = {end: (reached[end][0], order.index(end), (reached[end][3], reached[end][2])) for end in reached}
        self.counts[0] += codes.count(BLANK)
        self.counts[1] += codes.count(DUPLICATE)
        self.counts[2] += sum(c.isupper() for c in codes)
        beside = self.last + letters
        self.illegal += sum(beside[i:i + 2] not in LAWFUL for i in range(len(beside) - 1))
        self.last = letters[-1:] or self.last

    def best(self) -> tuple[int, str]:
        cost, _, tail, chain = min(
            (cost + CLOSING[end][0], rank, CLOSING[end][1], chain) for end, (cost, rank, chain) in self.live.items())
        parts = [tail]
        while chain is not None:
            chain, edits = chain
            parts.append(edits)
        return cost, "".join(reversed(parts))


# ---- rows in order, faults, segments

SPACE = " \t\n\x0b\x0c\r"


def _digest(part: int) -> Column:
    """One of two numbers that tell role and text apart from others: 60 bits each of their SHA-256."""
    whole = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return F.conv(F.substring(whole, 1 + 15 * part, 15), 16, 10).cast("long")


def _prepared(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return (turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
            .withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")}).withColumns({"d1": _digest(0), "d2": _digest(1)}))


def _segments(rows: DataFrame) -> DataFrame:
    """(conv, segment, codes, letters): each row's code and its role's first letter, in order."""
    # The last character but white space tells whether a text is blank and how it ends.
    end = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    letter = F.substring("role", 1, 1)
    plain = F.when(letter.isin("s", "u", "a"), letter).otherwise(OTHER)
    narrow = saved_table(rows.select(
        "conv", "turn", "d1", "d2", plain.alias("letter"), (end == "").alias("blank"),
        (~end.isin(".", "!", "?")).alias("truncated")).withColumn("row", F.monotonically_increasing_id()), "repair-rows")
    placed = with_row_number(narrow, ["conv"], ["turn", "d1", "d2", "row"], "place")
    # The same role and text earlier in the conversation; a hot conversation or text is cut by turn and row.
    again = with_row_number(narrow.select("conv", "d1", "d2", "turn", "row"), ["conv", "d1", "d2"], ["turn", "row"], "copy")
    coded = placed.join(again.where("copy > 1").select("row", F.lit(True).alias("again")), "row", "left").withColumn(
        "code", F.when(F.col("blank"), BLANK).when(F.col("again"), DUPLICATE)
        .when(F.col("truncated"), F.upper("letter")).otherwise(F.col("letter")))
    parts = coded.groupBy("conv", F.expr(f"(place - 1) div {SEGMENT}").alias("segment")).agg(
        F.array_sort(F.collect_list(F.struct("place", "code", "letter"))).alias("rows"))
    return parts.select("conv", "segment", *[F.array_join(f"rows.{c}", "").alias(f"{c}s") for c in ("code", "letter")])


PATHS = "array<struct<entry:int,end:int,cost:long,edits:string>>"
_PATHS = pa.list_(pa.struct([("entry", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[dict(zip(("entry", "end", "cost", "edits"), path)) for path in segment_paths(codes, number == 0)]
                 for codes, number in zip(batch.column("codes").to_pylist(), batch.column("segment").to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _PATHS)], [*batch.schema.names, "paths"])


# ---- paths joined and applied

OUT = ("conv {kind}, position long, role string, text string, blank long, duplicate long, truncated long, illegal long, "
       "cost long, audit string, digest string")
_FIELDS = ["position", "role", "text", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest"]


class _Conversation:
    """One conversation on its way: first its segments, then its rows."""

    def __init__(self, key):
        self.key, self.joined, self.audit = key, Joined(), None
        self.state, self.at, self.written, self.hash = START, 0, 0, hashlib.sha256()

    def segment(self, codes: str, letters: str, paths: list[dict]) -> None:
        self.joined.add(codes, letters, [tuple(p.values()) for p in paths])

    def _write(self, role: str, text: str) -> tuple:
        self.state = NEXT[self.state, role[0]]
        self.hash.update((("\n" if self.written else "") + role + ":" + text).encode())
        self.written += 1
        return (self.key, self.written, role, text, *[None] * 7)

    def _inserted(self) -> Iterator[tuple]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._write("assistant" if self.state == USER else "user", "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        if self.audit is None:
            self.cost, self.audit = self.joined.best()
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            yield self._write(role, text)
        elif edit == "R":
            yield self._write("assistant" if self.state == USER else "user", text)

    def close(self) -> Iterator[tuple]:
        yield from self._inserted()
        yield (self.key, None, None, None, *self.joined.counts, self.joined.illegal, self.cost, self.audit,
               self.hash.hexdigest())


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, out, size, kind = None, [], 0, None

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out))
        types = [kind, pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 5, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv", *_FIELDS])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for key, segment, codes, letters, paths, role, text in zip(
                *[batch.column(c).to_pylist() for c in ("conv", "segment", "codes", "letters", "paths", "role", "text")]):
            if current is None or key != current.key:
                if current is not None:
                    out += current.close()
                current = _Conversation(key)
            if paths is not None:
                current.segment(codes, letters, paths)
            else:
                out += current.row(role, text)
                size += len(text)
            if len(out) >= 10_000 or size > 1 << 20:
                if out:
                    yield flush()
                out, size = [], 0
    if current is not None:
        out += current.close()
    if out:
        yield flush()


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """The repaired rows of each conversation, and for each one row without a position that says what was done.

    Columns: the conversation, position (from 1), role, text; in the row without a position blank, duplicate, truncated
    (rows by their first fault), illegal (neighbouring rows whose roles' first letters are not su, ua or au), cost, audit
    (the edits' letters) and digest (SHA-256 of the repaired ``role:text`` rows, joined by line feeds).

    Rows are taken by turn, nulls first; rows of one turn by a digest of role and text. A null role or text counts as one
    space, so that the row is blank or can only be reroled. A null conversation is one like others. A conversation of
    unusable rows comes out empty, with its cost and audit; a table without rows gives none. Repeated
    rows are duplicates and go. Texts are whole, and other columns are ignored.
    """
    rows = _prepared(turns, conv, turn, role, text)
    kind = rows.schema["conv"].dataType.simpleString()
    paths = _segments(rows).mapInArrow(
        _searched, f"conv {kind}, segment long, codes string, letters string, paths {PATHS}")
    stream = paths.select("conv", "segment", "codes", "letters", "paths", *[
        F.lit(None).cast(t).alias(c) for c, t in (("turn", turns.schema[turn].dataType), ("d1", "long"), ("d2", "long"),
                                                  ("role", "string"), ("text", "string"))])
    stream = stream.unionByName(rows, allowMissingColumns=True)
    by = [F.col("conv"), F.col("segment").asc_nulls_last(), F.col("turn"), F.col("d1"), F.col("d2")]
    out = stream.repartition("conv").sortWithinPartitions(*by).drop("turn", "d1", "d2").mapInArrow(
        _applied, OUT.format(kind=kind))
    return out.withColumnRenamed("conv", conv)


def turn_gaps(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", counted: Column | None = None) -> DataFrame:
    """(conv, gaps) of all conversations: turn numbers missing between the least and the greatest, null turns aside.

    Rows that are not ``counted`` name their conversation only. Without turns there is no gap.
    """
    seen = F.col(turn) if counted is None else F.when(counted, F.col(turn))
    wide = [f(seen.cast("decimal(20,0)")) for f in (F.max, F.min)]
    gaps = wide[0] - wide[1] + 1 - F.count_distinct(seen)
    return turns.groupBy(conv).agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"))
