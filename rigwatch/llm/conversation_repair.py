"""Repair of conversations whose turns were lost, emptied, cut, repeated or given the wrong role.

A conversation is aligned with the grammar ``(s?(ua)+)?`` over role initials (system, user, assistant) by edits:
keep a turn (0), change its role to user or assistant (3), delete it (4, the only choice for a blank turn or one
whose role and text came before), insert an empty user or assistant turn (3); a cut-off turn that isn't deleted costs 3 more.

The alignment is Wagner and Fischer's table of turns against the grammar's string. As the string alternates, the
string of any feasible length is an end of one long string, so a table that counts its columns from the end has
the cost for every feasible length in its first row, with one more row of states for a leading system turn.
Columns are kept in a band around the diagonal (Ukkonen): a first, simple repair gives the incumbent cost, and
what it spends beyond the unavoidable bounds the insertions and deletions that a cheaper one can hold.
Among all lengths of least cost the audits (initials of the edits) are traced back together and compared letter by letter;
the least in ASCII order wins, a shorter one before its extensions.

Turns reach the alignment as a sorted stream and stay there with a byte each; a conversation is never held with its texts. The table
keeps every ``sqrt(n)``-th row and computes the rows between again while tracing. Repaired turns are put together in a second sorted
stream that has the audit before the turns.

Defined results: a null role or text is one space; turns stand in order of their number, nulls first, ties by role, then by digest of the text;
a null conversation is one like any other; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3   # costs
TABLE_CELLS = 1 << 22                               # larger tables keep some rows only
CACHED, CACHED_TURNS = 50_000, 64                   # alignments of short conversations that a worker remembers
FAR = np.int32(1 << 29)
SPACE = " \t\n\x0b\x0c\r"

# A turn's byte: 0 system, 1 user, 2 assistant, 3 other; plus its fault.
FINE, BLANKS, REPEATS, CUTS = 0, 4, 8, 12
AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPAIRED = "conv_id long, step long, edit string, role string, text string"


# Alignment ---------------------------------------------------------------------------------------

class _Table:
    """Costs to finish from turn ``i`` with ``r`` characters of the target left, in a band around the turns left."""

    def __init__(self, codes: np.ndarray):
        self.role, fault = (codes & 3).tolist(), codes & 12
        self.gone = np.isin(fault, (BLANKS, REPEATS)).tolist()
        self.extra = np.where(fault == CUTS, CUT, 0).tolist()
        self.n = len(codes)
        self.left = np.concatenate([np.cumsum(1 - np.array(self.gone, int)[::-1])[::-1], [0]]).astype(int).tolist()
        # What the incumbent spends beyond the unavoidable: deletions of cut turns cost 1 of it, of others 4, insertions 3.
        cuts = sum(1 for e, g in zip(self.extra, self.gone) if e and not g)
        spare = self.incumbent() - DELETE * (self.n - self.left[0]) - CUT * cuts
        self.less = min(min(cuts, spare) + max(0, spare - cuts) // DELETE, self.left[0])
        self.width = self.less + spare // INSERT + 1
        self.lift = INSERT * np.arange(self.width, dtype=np.int32)
        self.step = math.isqrt(self.n) if self.n * self.width > TABLE_CELLS else 1
        row = self.last()
        self.kept: dict[int, tuple] = {self.n: row}
        for i in range(self.n - 1, -1, -1):
            row = self.row(i, *row)
            if i % self.step == 0:
                self.kept[i] = row
        self.block: dict[int, tuple] = {}

    def incumbent(self) -> int:
        """Cost of a simple repair: go on with what is expected, insert where a role comes twice, change the others."""
        cost, expected, leads, length = 0, 1, False, 0
        for i in range(self.n):
            if self.gone[i]:
                cost += DELETE
                continue
            cost += self.extra[i]
            if self.role[i] == 0 and not leads and not length:
                leads = True
            elif self.role[i] in (1, 2):
                cost += KEEP if self.role[i] == expected else INSERT
                expected, length = 3 - self.role[i], length + 1
            else:
                cost += REROLE
                expected, length = 3 - expected, length + 1
        if expected == 2:
            cost += INSERT
        return cost + (2 * INSERT if leads and not length else 0)

    def remaining(self, i: int) -> np.ndarray:
        """Characters left in each column of row ``i``; negative ones don't exist."""
        return self.left[i] - self.less + np.arange(self.width)

    def last(self) -> tuple[np.ndarray, np.ndarray]:
        r = self.remaining(self.n)
        return np.where(r < 0, FAR, INSERT * r).astype(np.int32), np.full(self.width, FAR, np.int32)

    def row(self, i: int, below: np.ndarray, below_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ``i`` from row ``i + 1``: costs inside the pairs, and costs while a system turn may still come."""
        if self.gone[i]:
            cost, first = below + DELETE, below_first + DELETE
        else:
            r = self.remaining(i)
            cost, first = np.full(self.width, FAR), np.full(self.width, FAR)
            cost[:-1], first[:-1] = below[1:] + DELETE, below_first[1:] + DELETE
            wanted = np.where(r % 2 == 0, 1, 2)
            pair = below + self.extra[i] + np.where(wanted == self.role[i], KEEP, REROLE)
            cost = np.minimum(cost, np.where(r >= 1, pair, FAR))
            if self.role[i] == 0:
                first = np.minimum(first, np.where((r >= 3) & (r % 2 == 1), below + self.extra[i], FAR))
        cost = np.minimum.accumulate(np.minimum(cost, FAR) - self.lift) + self.lift
        return np.where(self.remaining(i) < 0, FAR, np.minimum(cost, FAR)).astype(np.int32), np.minimum(first, FAR).astype(np.int32)

    def at(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i in self.kept:
            return self.kept[i]
        if i not in self.block:
            top = min(self.n, (i // self.step + 1) * self.step)
            row, self.block = self.kept[top], {}
            for k in range(top - 1, i - i % self.step, -1):
                row = self.block[k] = self.row(k, *row)
        return self.block[i]

    def trace(self) -> tuple[int, str]:
        """Least cost over all feasible lengths, and the least audit that has it."""
        pairs, first = self.at(0)
        r = self.remaining(0)
        pairs = np.where(r % 2 == 0, pairs, FAR)
        best = int(min(pairs.min(), first.min()))
        inside, start = np.flatnonzero(pairs == best), np.flatnonzero(first == best)  # columns of the lengths still alike
        i, togo, audit = 0, best, []
        while True:
            done = i == self.n
            shift = 0 if done or self.gone[i] else 1
            if done and (self.remaining(i)[inside] == 0).any():
                return best, "".join(audit)
            rest = self.remaining(i)
            here, _ = self.at(i)
            if not done:
                below, below_first = self.at(i + 1)
                a, b = inside + shift, start + shift
                a, b = a[a < self.width], b[b < self.width]
                a, b = a[below[a] + DELETE == togo], b[below_first[b] + DELETE == togo]
                if len(a) or len(b):
                    audit.append("D")
                    inside, start, togo, i = a, b, togo - DELETE, i + 1
                    continue
            a = inside[(inside >= 1) & (rest[inside] >= 1)] - 1
            a = a[here[a] + INSERT == togo]
            if len(a):
                audit.append("I")
                inside, start, togo = a, start[:0], togo - INSERT
                continue
            alike = np.where(rest[inside] % 2 == 0, 1, 2) == self.role[i]
            a = inside[(rest[inside] >= 1) & alike]
            a = a[below[a] + self.extra[i] == togo]
            b = start[(rest[start] >= 3) & (rest[start] % 2 == 1)] if self.role[i] == 0 else start[:0]
            b = b[below[b] + self.extra[i] == togo]
            if len(a) or len(b):
                audit.append("K")
                inside, start, togo, i = np.union1d(a, b), start[:0], togo - self.extra[i], i + 1
                continue
            a = inside[rest[inside] >= 1]
            a = a[below[a] + self.extra[i] + REROLE == togo]
            audit.append("R")
            inside, start, togo, i = a, start[:0], togo - self.extra[i] - REROLE, i + 1


def align(codes: bytes) -> tuple[int, str]:
    """Least cost and audit of a conversation, from a byte per turn."""
    return _align(codes) if len(codes) <= CACHED_TURNS else _Table(np.frombuffer(codes, np.uint8)).trace()


@lru_cache(CACHED)
def _align(codes: bytes) -> tuple[int, str]:
    return _Table(np.frombuffer(codes, np.uint8)).trace()


# Streams -----------------------------------------------------------------------------------------

class _Conversation:
    """Counts of a conversation on its way through the stream: a byte per turn and a digest per distinct one."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.codes, self.said = conv_id, bytearray(), set()
        self.first = self.last = None
        self.distinct = 0

    def add(self, turns: list, codes: list, said: list) -> None:
        for turn, code, digest in zip(turns, codes, said):
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last, self.distinct = turn, self.distinct + 1
            if code & 12 != BLANKS:
                if digest in self.said:
                    code = code & 3 | REPEATS
                self.said.add(digest)
            self.codes.append(code)

    def row(self) -> tuple:
        seen = np.frombuffer(bytes(self.codes), np.uint8)
        fault, role = seen & 12, seen & 3
        illegal = ~np.isin(role[:-1] * 4 + role[1:], (1, 6, 9))  # su, ua, au
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        return (self.conv_id, gaps, *[int((fault == f).sum()) for f in (BLANKS, REPEATS, CUTS)], int(illegal.sum()),
                *align(bytes(self.codes)))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, ddl.split(","))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _runs(column: pa.Array) -> Iterator[tuple[int | None, int, int]]:
    """Value, from, to of every run of equal values."""
    if len(column):
        values, valid = np.asarray(column.fill_null(0)), np.asarray(column.is_valid())
        cuts = (np.flatnonzero((values[1:] != values[:-1]) | (valid[1:] != valid[:-1])) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(values)]):
            yield (int(values[a]) if valid[a] else None), a, b


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, schema = None, _schema(AUDIT)
    for b in batches:
        out, columns = [], [b.column(c).to_pylist() for c in ("turn", "code", "said")]
        for conv_id, start, end in _runs(b.column("conv_id")):
            if now is None or now.conv_id != conv_id:
                out += [] if now is None else [now.row()]
                now = _Conversation(conv_id)
            now.add(*[c[start:end] for c in columns])
        if out:
            yield _batch(out, schema)
    if now is not None:
        yield _batch([now.row()], schema)


class _Repair:
    """A conversation's audit, applied to its turns as they come."""

    def __init__(self, conv_id: int | None, audit: str):
        self.conv_id, self.audit, self.at = conv_id, audit, 0
        self.left = sum(map(audit.count, "KRI"))  # characters of the target

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield self.step(None, "")

    def step(self, role: str | None, text: str) -> tuple:
        edit, place = self.audit[self.at], self.at
        if edit in "RI":
            role = "user" if self.left % 2 == 0 else "assistant"
        self.left -= edit != "D"
        self.at += 1
        return self.conv_id, place, edit, role, text


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, schema = None, _schema(REPAIRED)
    for b in batches:
        out = []
        for conv_id, audit, role, text in zip(*[b.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")]):
            if audit is not None:  # sorted before the turns
                out += [] if now is None else now.inserted()
                now = _Repair(conv_id, audit)
            else:
                out += [*now.inserted(), now.step(role, text)]
        if out:
            yield _batch(out, schema)
    if now is not None and (out := list(now.inserted())):
        yield _batch(out, schema)


# Operators ---------------------------------------------------------------------------------------

def _prepared(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` without null texts, the turn's byte and a digest of what was said."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    end, first = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1), F.substring("role", 1, 1)
    fault = F.when(end == "", BLANKS).when(end.isin(".", "!", "?"), FINE).otherwise(CUTS)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return rows.select("*", (initial + fault).alias("code"),
                       F.unhex(F.md5(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"))).alias("said"))


def audits(turns: DataFrame) -> DataFrame:
    """Faults, cost and cheapest audit of every conversation of ``turns`` (``conv_id, turn, role, text``)."""
    slim = _prepared(turns).select("conv_id", "turn", "role", "said", "code")
    return (slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "said")
            .select("conv_id", "turn", "code", "said").mapInArrow(_audits, AUDIT))


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """Every step of every audit: ``conv_id, step, edit, role, text``; without edit ``D`` the repaired conversations."""
    marks = audited.select("conv_id", "audit")
    both = marks.unionByName(_prepared(turns).drop("code"), allowMissingColumns=True)
    return (both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "said")
            .select("conv_id", "audit", "role", "text").mapInArrow(_repairs, REPAIRED))
