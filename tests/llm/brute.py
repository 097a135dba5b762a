"""Plain single-process versions of the contracts, for comparison."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    t = text or ""
    w = words(t)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen = Counter(windows)
    covered = set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(w)
    return {"n_words": n, "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": n < 20 or 100 * len(covered) > 30 * n}


def targets(sizes: dict, pattern=(5, 2, 1), share=1.5, epochs=2.0):
    """Capped water-filling over source -> words."""
    order = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: pattern[i % len(pattern)] for i, s in enumerate(order)}
    left, budget, out = set(order), share * sum(sizes.values()), {}
    while left:
        total = sum(weight[s] for s in left)
        over = [s for s in left if budget * weight[s] / total > epochs * sizes[s]]
        if not over:
            return out | {s: budget * weight[s] / total for s in left}
        for s in over:
            out[s] = epochs * sizes[s]
        budget -= sum(out[s] for s in over)
        left -= set(over)
    return out


def crc(text):
    return zlib.crc32((text or "").encode())


def groups(pairs):
    out = defaultdict(list)
    for k, v in pairs:
        out[k].append(v)
    return out
