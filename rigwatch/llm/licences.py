"""Licence scans: Aho-Corasick over words, and a shunting-yard parser for licence expressions.

A text is lower-cased (A-Z) and cut into words of digits, letters and all characters beyond ASCII.
One automaton finds the base phrases, further notice phrases and the identifier tag in the words.
Where the tag stands as ``SPDX-License-Identifier:``, what follows on its line is parsed as an
expression, ``with`` before ``and`` before ``or``; ``with`` joins one identifier and one exception.
A phrase inside a longer one that was found counts for the base columns only: a "GNU Lesser General
Public License" is ``lgpl``, and the base label ``gpl`` stays beside it. Phrases inside an expression
are left to the expression. The score is the freedom
that the licences leave: the best branch of an ``or``, the worst of an ``and``, an exception half-way
to free, and the worst of all tags and notices of a text; 0 if there are none.

Defined results: null and empty texts have no words; a broken expression counts as all its
identifiers joined by ``and``; unknown identifiers have score 0.5 and no label; repeated and crossing
phrases all count; repeated rows are scanned alike; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notice phrases of the method, as words.
NOTICES = {
    "mit licence": "mit", "licensed under the mit": "mit", "licensed under mit": "mit", "permission is hereby granted free of charge": "mit", "expat license": "mit",
    "apache software license": "apache", "licensed under the apache": "apache", "apache 2 0": "apache", "apache 2 0 license": "apache",
    "bsd license": "bsd", "bsd licence": "bsd", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "2 clause bsd": "bsd", "3 clause bsd": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc", "permission to use copy modify and or distribute this software": "isc",
    "zlib license": "zlib", "boost software license": "bsl", "unlicense": "unlicense", "free and unencumbered software": "unlicense",
    "artistic license": "artistic", "python software foundation license": "psf", "postgresql license": "postgresql",
    "mozilla public license": "mpl", "eclipse public license": "epl", "common development and distribution license": "cddl",
    "european union public licence": "eupl", "microsoft public license": "ms-pl", "sil open font license": "ofl", "open font license": "ofl",
    "lesser general public license": "lgpl", "library general public license": "lgpl", "affero general public license": "agpl", "gnu gpl": "gpl",
    "gnu lgpl": "lgpl", "gnu agpl": "agpl", "gnu free documentation license": "gfdl",
    "server side public license": "sspl", "business source license": "busl", "open database license": "odbl",
    "cc0": "cc0", "cc by": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc", "cc by nc nd": "cc-by-nc",
    "creative commons zero": "cc0", "creative commons attribution": "cc-by", "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa", "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc", "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noderivs": "cc-by-nd",
    "public domain": "public-domain", "all rights reserved": "reserved", "proprietary and confidential": "reserved",
}
TAG = "spdx license identifier"
TAG_TEXT = b"spdx-license-identifier"
# Freedom that a family of licences leaves. An identifier belongs to the longest family that it starts with, before its version.
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "0bsd": 1.0, "isc": 1.0, "zlib": 1.0, "bsl": 1.0, "unlicense": 1.0, "cc0": 1.0, "public-domain": 1.0, "wtfpl": 1.0,
    "psf": 1.0, "python": 1.0, "postgresql": 1.0, "ncsa": 1.0, "x11": 1.0, "openssl": 0.9, "afl": 0.9, "artistic": 0.9, "cc-by": 0.9, "ms-pl": 0.8, "ofl": 0.8,
    "mpl": 0.7, "epl": 0.7, "cpl": 0.7, "cddl": 0.7, "ms-rl": 0.6, "eupl": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "odbl": 0.5, "gfdl": 0.5, "osl": 0.4, "gpl": 0.4,
    "agpl": 0.3, "sspl": 0.2, "busl": 0.2, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "reserved": 0.0,
}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

# A-Z become small; ASCII other than letters and digits becomes a blank; other bytes stay.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: operands and operators in evaluation order; None if the expression is broken."""
    out, stack, before = [], [], ["or", "or"]  # the last two tokens, as if an operand comes next
    for token in re.findall(r"[()]|[^\s()]+", expression.lower()):
        operand_next = before[1] == "(" or before[1] in PRECEDENCE
        if token == "(":
            if not operand_next or before[1] == "with":
                return None
            stack.append(token)
        elif operand_next != (token != ")" and token not in PRECEDENCE):
            return None
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif token in PRECEDENCE:
            if token == "with" and (before[1] == ")" or before[0] == "with"):  # after one identifier, and an exception has none
                return None
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
        else:
            out.append(token)
        before = [before[1], token]
    if before[1] == "(" or before[1] in PRECEDENCE or "(" in stack:
        return None
    return out + stack[::-1]


def family(identifier: str) -> str | None:
    """The longest family that the identifier is, or starts with before a sign or digit."""
    name, found = identifier.lower(), None
    for f in FREEDOM:
        if name.startswith(f) and (len(name) == len(f) or name[len(f)] in "-+." or name[len(f)].isdigit()) and len(f) > len(found or ""):
            found = f
    return found


def evaluate(expression: str) -> tuple[set[str], float]:
    """Labels named by an expression, and its score."""
    steps = postfix(expression)
    if steps is None:
        names = [t for t in re.findall(r"[^\s()]+", expression.lower()) if t not in PRECEDENCE]
        steps = names + ["and"] * (len(names) - 1)
    stack: list[tuple[set[str], float]] = []
    for s in steps:
        if s in PRECEDENCE:
            (right, b), (left, a) = stack.pop(), stack.pop()
            score = max(a, b) if s == "or" else min(a, b) if s == "and" else a + (1 - a) / 2
            stack.append((left if s == "with" else left | right, score))
        else:
            f = family(s)
            stack.append(({f} if f else set(), FREEDOM.get(f, 0.5)))
    return stack[-1] if stack else (set(), 0.5)


def automaton():
    """One automaton over all phrases, blanks around them, as code points of single bytes."""
    import ahocorasick
    found = ahocorasick.Automaton()
    for phrase in dict.fromkeys([*BASE_PHRASES, *NOTICES, TAG]):
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def expressions(text: str, ends: list[int]) -> Iterator[tuple[int, int, str]]:
    """Expressions after the tags whose last words have these numbers, with their first word and the one after them.

    An expression ends with its line or at the next tag.
    """
    raw = text.encode("utf-8", "surrogatepass")
    places, number, after = re.finditer(rb"[^ ]+", raw.translate(_WORD_BYTES)), -1, []
    for end in ends:
        while number < end:
            place, number = next(places), number + 1
        after.append(place.end())
    for end, at, limit in zip(ends, after, [*(a - len(TAG_TEXT) for a in after[1:]), len(raw)]):
        stop = raw.find(b"\n", at, limit)
        rest = raw[at:stop if stop >= 0 else limit]
        if raw[max(0, at - len(TAG_TEXT)):at].lower() == TAG_TEXT and rest.lstrip(b" \t").startswith(b":"):
            expression = rest.decode("utf-8", "surrogatepass").lstrip(" \t")[1:].strip().rstrip("*/#->; \t\r")
            yield end + 1, end + 1 + len(words_of(expression)), expression


def scan(text: str | None, found) -> tuple:
    """``n_words, n_base, first_word, last_word, base_labels, labels, score`` of a text."""
    words = words_of(text)
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts, base, labels, scores, tags, spans, at, number = [], set(), set(), [], [], [], 0, 0
    for end, phrase in found.iter(line):
        first = end - len(phrase) - 1  # of the blank before the phrase
        number += line.count(" ", at, first) if first >= at else -line.count(" ", first, at)
        at = first
        if phrase == TAG:
            tags.append(number + TAG.count(" "))
            continue
        spans.append((first, -end, number, phrase))
        if phrase in BASE_PHRASES:
            starts.append(number)
            base.add(BASE_PHRASES[phrase])
    parsed, reach, passed = list(expressions(text, tags)) if tags else [], -1, 0
    for _, end, number, phrase in sorted(spans):  # from each start the longest first: one that ends no later than those before lies inside
        while passed < len(parsed) and parsed[passed][1] <= number:
            passed += 1
        named = passed < len(parsed) and parsed[passed][0] <= number  # by an expression, which says what it counts for
        if -end > reach and not named:
            reach = -end
            labels.add(BASE_PHRASES.get(phrase) or NOTICES[phrase])
    scores += [FREEDOM[x] for x in labels]
    for _, _, expression in parsed:
        more, score = evaluate(expression)
        labels |= more
        scores.append(score)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), min(scores, default=0.0))


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = [p.split()[0] for p in SCHEMA.split(", ")]
    found = automaton()
    for b in batches:
        rows = list(zip(*[scan(t.as_py(), found) for t in b.column(1)])) or [[]] * 7
        yield pa.record_batch([b.column(0), *[pa.array(c, k) for c, k in zip(rows, kinds)]], names)


def scan_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document; texts are scanned whole, one at a time, without a shuffle."""
    return docs.selectExpr(f"cast(`{doc_id}` as long)", f"`{text}`").mapInArrow(_scan_batches, SCHEMA)
