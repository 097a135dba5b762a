import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from rigwatch.llm import conversation_repair as repair
from rigwatch.llm.queries import damaged
from rigwatch.llm.registry import QUERIES
from tests.llm.odd import saved

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


def search(codes):
    """Cheapest audit, ASCII-least, by a search over (turn, characters made, target) in order of (cost, audit)."""
    best = (10**9, "")
    n = len(codes)
    for length in [0, *range(2, 2 * n + 4)]:
        target = ("s" if length % 2 else "") + "ua" * (length // 2)
        heap, seen = [(0, "", 0, 0)], set()
        while heap:
            cost, audit, i, j = heapq.heappop(heap)
            if (i, j) in seen:
                continue
            seen.add((i, j))
            if (cost, audit) >= best:
                break
            if i == n and j == length:
                best = (cost, audit)
                break
            if i < n:
                heapq.heappush(heap, (cost + 4, audit + "D", i + 1, j))
            if j < length:
                if target[j] != "s":
                    heapq.heappush(heap, (cost + 3, audit + "I", i, j + 1))
                if i < n and codes[i] & 12 not in (repair.BLANKS, repair.REPEATS):
                    extra = 3 if codes[i] & 12 == repair.CUTS else 0
                    if "sua?"[codes[i] & 3] == target[j]:
                        heapq.heappush(heap, (cost + extra, audit + "K", i + 1, j + 1))
                    elif target[j] != "s":
                        heapq.heappush(heap, (cost + extra + 3, audit + "R", i + 1, j + 1))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_alignment_equals_search(seed):
    rng = random.Random(seed)
    for _ in range(150):
        weights = rng.choice([(1, 1, 1, 1), (1, 4, 4, 0), (3, 1, 1, 0)])
        codes = bytes(rng.choices(range(4), weights)[0] + rng.choices((0, 4, 8, 12), (6, 1, 1, 2))[0] for _ in range(rng.randint(0, 9)))
        assert repair.align(codes) == search(codes), codes


def test_rows_between_kept_ones_are_computed_again(monkeypatch):
    rng = random.Random(5)
    for n in (1, 2, 7, 40, 130):
        codes = np.array([rng.choice((0, 1, 1, 2, 2, 3)) + rng.choice((0, 0, 0, 4, 8, 12)) for _ in range(n)], np.uint8)
        whole = repair._Table(codes).trace()
        monkeypatch.setattr(repair, "TABLE_CELLS", 0)
        assert repair._Table(codes).trace() == whole
        monkeypatch.undo()


def brute(rows):
    """The contract's result per conversation, in plain Python. ``rows``: conv_id, turn, role, text."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        group = groups[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        group += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = set()
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, codes, counts = set(), [], [0, 0, 0]
        for _, role, text in group:
            core = text.strip(SPACE)
            fault = 1 if not core else 2 if (role, text) in seen else 3 if core[-1] not in ".!?" else 0
            seen.add((role, text))
            if fault:
                counts[fault - 1] += 1
            codes.append(("sua".find(role[:1]) if role[:1] and role[0] in "sua" else 3) + 4 * fault)
        cost, audit = search(codes)
        turns = {t for t, _, _ in group if t is not None}
        roles = [r[:1] for _, r, _ in group]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        length, at, lines = sum(e != "D" for e in audit), 0, []
        target = ("s" if length % 2 else "") + "ua" * (length // 2)
        for edit in audit:
            row = None if edit == "I" else group[at]
            at += edit != "I"
            if edit != "D":
                name = {"u": "user", "a": "assistant"}.get(target[len(lines)])
                lines.append(f"{row[1] if edit == 'K' else name}:{row[2] if row else ''}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.add((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, digest))
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    got = QUERIES["op13_target_alignment"](spark, SF).select(*COLUMNS).collect()
    assert len(got) == len({r.conv_id for r in rows})
    assert {tuple(r) for r in got} == brute([(r.conv_id, r.turn, r.role, r.text) for r in rows])


def test_odd_conversations(spark, out):
    rng = random.Random(2)
    long = "word " * 200_000
    rows = [(None, None, None, None), (None, 1, "user", "a."), (1, None, "system", "x."), (1, None, "", " \t"), (1, 5, "user", long),
            (2, 1, "user", "same."), (2, 1, "user", "same."), (2, 2, "user", "same."), (3, 0, "system", "only."), (4, 3, "robot", "é!"),
            (-5, 0, "assistant", "漢字。"), (-5, 9, "assistant", "z?\n")]
    rows += [(c, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", "c!"])) for c in range(10, 40) for t in range(rng.randint(1, 7))]
    schema = "conv_id long, turn long, role string, text string, audit string, step int, code int"
    df = spark.createDataFrame([(*r, "DDD", 1, 2) for r in rows], schema)
    got = QUERIES["op13_target_alignment"](spark, saved(df, out, "conversations")).select(*COLUMNS).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {tuple(r) for r in got} == brute(rows)


def test_dropped_conversation_keeps_a_row(spark, out):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "gone.")], "conv_id long, turn long, role string, text string")
    rows = QUERIES["op13_target_alignment"](spark, saved(df, out, "conversations")).select(*COLUMNS).collect()
    assert [tuple(r) for r in rows] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert QUERIES["op13_target_alignment"](spark, saved(df.limit(0), out, "conversations")).count() == 0


def test_steps_are_the_audit(spark):
    turns = damaged(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    audits = repair.audits(turns)
    steps = repair.repaired(turns, audits).collect()
    by = defaultdict(list)
    for r in sorted(steps, key=lambda r: r.step):
        by[r.conv_id].append(r)
    for a in audits.collect():
        assert "".join(r.edit for r in by[a.conv_id]) == a.audit
        roles = "".join(r.role[0] for r in by[a.conv_id] if r.edit != "D")
        assert roles.removeprefix("s") == "ua" * (len(roles) // 2)
