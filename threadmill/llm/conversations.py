"""Repair of conversations by an auction for shortest edit paths.

A conversation's rows and the roles already put out span a lattice: a node is a
number of rows read and a state (nothing yet, a system row, a user row waiting for
its answer, an answered one); an arc is an edit with its integer cost. Rows may be
kept, given the role user or assistant, or deleted; empty user and assistant rows may
be inserted anywhere. The roles put out must be nothing, or an optional system row and
then user and assistant in turns, so from each node an edit leads to one other node.

The cheapest edits are found by the auction algorithm for shortest paths (Bertsekas
1991): every node has a price, never more than an arc's cost plus the price at its
end; a path grows from its origin over arcs where the two are equal, and where there
is none the last node's price is raised to the least such sum and the path gives it up.
Origins are taken from the last row back, so a path ends as soon as it meets a
node whose price is final, and prices are then exact distances to the end. Arcs whose
price difference is their cost are tight; every cheapest repair consists of tight
arcs, and following the first edit letter at every node (D, I, K, R) traces the
least audit. Prices matter only by their differences, of which few patterns occur, so
a layer's auction is remembered by them.

A conversation is never held whole: rows are dealt by conversation, sorted by Spark and
streamed twice, once without texts (a few bytes a row are kept for the path), and once
behind a row with the audit, when a conversation's repaired text is hashed as it passes.
One conversation is the work of one task, since its audit and its hash are one value.

Defined cases: a null role or text is one space, a null conversation is one of its own;
rows of a turn are ordered by role and a hash of the text, null turns first; a role
counts by its first character, and one of none, or of another letter than s, u and a,
cannot be kept; equal rows are duplicates of the first; a very long text is a row like
any other; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of what has been put out: nothing, a system row, an unanswered user row, an answered one.
EMPTY, SYSTEM, OPEN, ANSWERED = range(4)
BLANKS = " \t\n\x0b\x0c\r"
#: Rows by what may be done with them: the role's place in this, 8 more if truncated; GONE must be deleted.
INITIALS = "sua"
OTHER, GONE, LAST = 3, 16, 17

#: From each state, where a system, user and assistant row lead.
NEXT = ((SYSTEM, OPEN, None), (None, OPEN, None), (None, None, ANSWERED), (None, OPEN, None))


def arcs(kind: int, state: int) -> list[tuple[str, int, bool, int]]:
    """The edits at a node in order of their letters: letter, cost, whether the row is read, next state."""
    turn = ANSWERED if state == OPEN else OPEN  # the one role that may follow, system aside
    found = [] if kind == LAST else [("D", DELETE, True, state)]
    found.append(("I", INSERT, False, turn))
    if kind < GONE:
        extra = TRUNCATED if kind & 8 else 0
        role = kind & 7
        kept = NEXT[state][role] if role < OTHER else None
        if kept is not None:
            found.append(("K", KEEP + extra, True, kept))
        found.append(("R", REROLE + extra, True, turn))
    return found


@lru_cache(maxsize=100_000)
def layer(kind: int, after: tuple[int, ...]) -> tuple[int, tuple[int, ...], tuple[tuple[str, int], ...]]:
    """Prices of the four nodes before a row of ``kind``, given final prices ``after`` it.

    Returns the least price, the others relative to it, and for each state the letters
    up to the next row (or the end) on its first cheapest path, and the state there.
    ``after`` holds for the last layer only what ending costs: a state is final there or not.
    """
    out = [arcs(kind, s) for s in range(4)]
    price, final = [0] * 4, [False] * 4
    if kind == LAST:
        final[EMPTY] = final[ANSWERED] = True

    def at(read: bool, state: int) -> int:
        return after[state] if read else price[state]

    for origin in range(4):
        path = [origin]
        while not final[path[-1]]:
            here = path[-1]
            least, read, to = min((cost + at(read, s), read, s) for _, cost, read, s in out[here])
            if price[here] < least:
                price[here] = least
                if len(path) > 1:
                    path.pop()  # contraction
            elif read:
                break  # the row's far side is final
            else:
                path.append(to)  # extension
        for node in path:
            final[node] = True
    moves = []
    for state in range(4):
        letters, s = "", state
        while not (kind == LAST and s in (EMPTY, ANSWERED)):
            letter, _, read, to = next(a for a in out[s] if a[1] + at(a[2], a[3]) == price[s])
            letters, s = letters + letter, to
            if read:
                break
        moves.append((letters, s))
    low = min(price)
    return low, tuple(p - low for p in price), tuple(moves)


def cheapest(kinds: list[int] | np.ndarray) -> tuple[int, str]:
    """Cost and least audit of a conversation's rows by kind."""
    total, after, steps = 0, (0, 0, 0, 0), []
    for kind in (LAST, *reversed(bytes(kinds))):
        low, after, moves = layer(kind, after)
        total += low
        steps.append(moves)
    letters, state = [], EMPTY
    for moves in reversed(steps):
        some, state = moves[state]
        letters.append(some)
    return total + after[EMPTY], "".join(letters)


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, here) without texts: a mark of role and text, the role's place in INITIALS, blank and truncated."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    return rows.select("conv", "turn", "role", *marks(), "here", place.alias("place"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))


def marks() -> list[Column]:
    """A 128-bit mark of a text, which orders rows of the same turn and role."""
    return [F.xxhash64("text").alias("m1"), F.xxhash64(F.lit(1), "text").alias("m2")]


REPORT = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_LEGAL = {(0, 1), (1, 2), (2, 1)}


class _Conversation:
    """What is kept of a conversation while its rows pass: a byte a row, and counts."""

    def __init__(self) -> None:
        self.kinds = bytearray()
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = self.before = None

    def add(self, turn: int | None, place: int, blank: bool, again: bool, cut: bool) -> None:
        if turn is not None and turn != self.last:  # sorted, so each turn comes once
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        self.blank += blank
        self.duplicate += again and not blank
        truncated = cut and not (blank or again)
        self.truncated += truncated
        self.illegal += self.before is not None and (self.before, place) not in _LEGAL
        self.before = place
        self.kinds.append(GONE if blank or again else place + 8 * truncated)

    def row(self) -> tuple:
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, (1 << 63) - 1)
        cost, audit = cheapest(self.kinds)
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def report(rows: DataFrame) -> DataFrame:
    """conv, gaps, the number of rows by first fault, illegal neighbours, cost and audit of every conversation of ``rows``."""
    seen = Window.partitionBy("conv", "role", "m1", "m2").orderBy(F.col("here").desc(), F.asc_nulls_first("turn"))
    # a row is a duplicate where an equal one, or one of an earlier turn, comes before it
    marked = with_faults(rows).withColumn("again", F.row_number().over(seen) > 1)
    width = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << 20)
    order = ["conv", F.asc_nulls_first("turn"), "role", "m1", "m2", "again"]
    sorted_rows = marked.repartition(width, "conv").sortWithinPartitions(*order).select("conv", "turn", "here", "place", "blank", "again", "cut")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: _Conversation | None = None
        conv, done = None, []
        for batch in batches:
            names, turns = batch.column(0), batch.column(1).to_pylist()
            others = [batch.column(i).to_pylist() for i in range(2, 7)]
            for name, turn, here, place, blank, again, cut in zip(names.to_pylist(), turns, *others):
                if open_ is None or name != conv:
                    if open_ is not None:
                        done.append((conv, *open_.row()))
                    open_, conv = _Conversation(), name
                if here:
                    open_.add(turn, place, blank, again, cut)
            if done:
                yield _batch(done)
                done = []
        if open_ is not None:
            yield _batch([(conv, *open_.row())])

    return sorted_rows.mapInArrow(each, REPORT)


_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _batch(done: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*done))
    arrays = [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.int64()) for c in columns[1:7]], pa.array(columns[7], pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=["conv", *_NUMBERS, "audit"])


ROLES = {OPEN: "user", ANSWERED: "assistant"}


class _Editor:
    """Applies an audit to rows as they pass: each call gives the rows (edit, role, text) that are put out."""

    def __init__(self, audit: str):
        self.letters, self.at, self.state = audit, 0, EMPTY

    def _insert(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            self.state = ANSWERED if self.state == OPEN else OPEN
            yield "I", ROLES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._insert()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "D":
            return
        if letter == "K" and self.state == EMPTY and role[:1] == "s":
            self.state = SYSTEM
        else:
            self.state = ANSWERED if self.state == OPEN else OPEN
        yield letter, role if letter == "K" else ROLES[self.state], text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._insert()


def _streamed(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Each conversation's report, then its rows in order, in one partition."""
    head = reports.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("long").alias("m1"), F.lit(None).cast("long").alias("m2"), F.struct(*_NUMBERS, "audit").alias("found"), F.lit(None).cast("string").alias("text"))
    body = rows.filter("here").select("conv", F.lit(1).alias("kind"), "turn", "role", *marks(), F.lit(None).cast(head.schema["found"].dataType).alias("found"), "text")
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return head.unionByName(body).repartition(width, "conv").sortWithinPartitions("conv", "kind", F.asc_nulls_first("turn"), "role", "m1", "m2").select("conv", "kind", "turn", "role", "text", "found")


def digests(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The reports with ``repaired_sha256``, of each conversation's repaired ``role:text`` joined by line ends."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = editor = None
        sha, empty = hashlib.sha256(), True

        def put(rows: Iterator[tuple[str, str, str]]) -> None:
            nonlocal empty
            for _, role, text in rows:
                sha.update((f"{role}:" if empty else f"\n{role}:").encode())
                sha.update(text.encode())
                empty = False

        for batch in batches:
            done, names = [], batch.column(0)
            for i, kind in enumerate(batch.column(1).to_pylist()):
                if kind == 0:
                    if editor is not None:
                        put(editor.end())
                        done.append((*found, sha.hexdigest()))
                    f = batch.column(5)[i].as_py()
                    found, editor = (names[i].as_py(), *f.values()), _Editor(f["audit"])
                    sha, empty = hashlib.sha256(), True
                else:
                    put(editor.row(batch.column(3)[i].as_py(), batch.column(4)[i].as_py()))
            if done:
                yield _with_sha(done)
        if editor is not None:
            put(editor.end())
            yield _with_sha([(*found, sha.hexdigest())])

    return _streamed(rows, reports).mapInArrow(each, f"{REPORT}, repaired_sha256 string")


def _with_sha(done: list[tuple]) -> pa.RecordBatch:
    batch = _batch([d[:-1] for d in done])
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array([d[-1] for d in done], pa.string())], names=[*batch.schema.names, "repaired_sha256"])


def repaired_rows(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The repaired conversations: conv, place (from 1), edit (K, R or I), role and text of every row put out."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = editor = None
        place = 0
        for batch in batches:
            done, names = [], batch.column(0)

            def put(rows: Iterator[tuple[str, str, str]]) -> None:
                nonlocal place
                for edit, role, text in rows:
                    place += 1
                    done.append((name, place, edit, role, text))

            for i, kind in enumerate(batch.column(1).to_pylist()):
                if kind == 0:
                    if editor is not None:
                        put(editor.end())
                    name, editor, place = names[i].as_py(), _Editor(batch.column(5)[i].as_py()["audit"]), 0
                else:
                    put(editor.row(batch.column(3)[i].as_py(), batch.column(4)[i].as_py()))
            if done:
                yield _rows(done)
        if editor is not None:
            rest = [(name, place + 1 + i, *r) for i, r in enumerate(editor.end())]
            if rest:
                yield _rows(rest)

    return _streamed(rows, reports).mapInArrow(each, "conv long, place long, edit string, role string, text string")


def _rows(done: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=["conv", "place", "edit", "role", "text"])


def standard(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", here: Column | None = None) -> DataFrame:
    """The columns that the operator works on: conv (long), turn, role and text without nulls, here.

    A row that is not ``here`` only makes its conversation part of the result.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"), (F.lit(True) if here is None else here).alias("here"))


def repair(rows: DataFrame) -> DataFrame:
    """A report and a digest of every conversation of ``rows``, which :func:`standard` has made."""
    return digests(rows, written(report(rows), "repairs"))
