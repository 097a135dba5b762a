"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags. First pass, each block alone: blocks in excluded
elements or with many links are out; long blocks with many stop words are in; short ones, and long
ones with few stop words, stay ambiguous. Second pass: an ambiguous block takes the label of the
nearest decided block of its own container, then of the page; at a tie, the better one inside an
article and the worse one outside.

Defined results: null and empty pages, and pages without main text, give an empty text; cut-off
tags at the end are dropped; unclosed elements end with their parent; repeated rows are treated
alike; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

MIN_LENGTH = 70         # characters; shorter blocks are ambiguous
STOP_SHARE = 0.15       # of the words
LINK_SHARE = 0.5        # of the characters
STOP_WORDS = set("""
the of and to in a is that for it as was with on are be by this from or an at have not which but
de la le les des et en un une du que est pour dans qui sur pas au par plus avec il ce
el los las y del se por con para no su al lo como más o pero sus
der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er
""".split())
BLOCKS = set("""
address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody
td tfoot th thead tr ul
""".split())
EXCLUDED = set("""
head nav header footer aside form button select option textarea label input menu dialog iframe noscript template svg object
canvas audio video
""".split())
CONTAINERS = {"article", "main"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg"}
UNWANTED = re.compile(r"""(?ix)(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookie\w*|consent|notice|notices|alert|
popup|modal|overlay|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumb\w*|footer|header|masthead|comment|comments|
commentlist|disqus|replies|related|recommend\w*|share|sharing|social|newsletter|subscribe|signup|login|search|pagination|pager|
widget|toolbar|skip|copyright|legal|disclaimer)(?=$|[\s_-]|\d)""")
ROLES = re.compile(r"(?i)^(navigation|banner|contentinfo|complementary|search|form|dialog|alert|menu|menubar|toolbar)$")
TOKEN = re.compile(r"""(?s)<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)
|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)(?:>|$)""".replace("\n", ""))
ATTRIBUTE = re.compile(r"""(?i)(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class _Block:
    __slots__ = ("parts", "linked", "out", "container")

    def __init__(self, out: bool, container: int):
        self.parts, self.linked, self.out, self.container = [], 0, out, container


def unwanted(name: str, attrs: str) -> bool:
    """Whether an element is page furniture by its name or attributes."""
    if name in EXCLUDED:
        return True
    if not attrs:
        return False
    for m in ATTRIBUTE.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if ROLES.match(value) if key == "role" else key in ("class", "id") and name not in ("body", "html", "main", "article") and UNWANTED.search(value):
            return True
    return False


def blocks_of(page: str) -> list[_Block]:
    """Blocks of a page with text, in order. Every tag is handled once, however deep elements are nested."""
    found: list[_Block] = []
    bottom = ("", False, 0, -1)
    stack: list[tuple[str, bool, int, int]] = []  # name, excluded, container, place of the innermost block-level element
    unclosed: defaultdict[str, int] = defaultdict(int)
    current, at, containers = _Block(False, 0), 0, 0

    def close() -> None:
        nonlocal current
        if current.parts:
            found.append(current)
        top = stack[-1] if stack else bottom
        current = _Block(top[1], top[2])

    def leave(depth: int) -> None:
        for e in stack[depth:]:
            unclosed[e[0]] -= 1
        del stack[depth:]

    def text(raw: str) -> None:
        if raw:
            plain = html.unescape(raw) if "&" in raw else raw
            current.parts.append(plain)
            if unclosed["a"]:
                current.linked += len("".join(plain.split()))

    while True:
        m = TOKEN.search(page, at)
        text(page[at:m.start() if m else len(page)])
        if not m:
            break
        at, name = m.end(), (m["name"] or "").lower()
        if not name:
            continue
        if name == "br" or name == "wbr":
            current.parts.append(" " if name == "br" else "")
        elif m["end"]:
            if unclosed[name]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
                if name in BLOCKS or name in RAW:
                    close()
        elif name in RAW:  # no markup inside: skip to its end
            end = re.compile(rf"(?i)</{name}\s*>").search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID:
            if name == "p" or name == "li" or name in ("dt", "dd", "tr", "td", "option"):  # ends an open one of its kind
                inner = stack[-1][3] if stack else -1
                if inner >= 0 and stack[inner][0] == name:
                    leave(inner)
            above = stack[-1] if stack else bottom
            if name in CONTAINERS:
                containers += 1
            own = name == "header" and above[2] > 0  # an article's own header holds its title
            out = above[1] or unwanted("div" if own else name, m["attrs"])
            stack.append((name, out, containers if name in CONTAINERS else above[2], len(stack) if name in BLOCKS else above[3]))
            unclosed[name] += 1
            if name in BLOCKS or stack[-1][1] != above[1]:
                close()
        elif name in BLOCKS:
            close()
    close()
    return found


def label(block: _Block, text: str) -> bool | None:
    """First pass: in, out, or None for ambiguous."""
    if block.out:
        return False
    solid = len(text.replace(" ", ""))
    if block.linked > LINK_SHARE * solid:
        return False
    if len(text) < MIN_LENGTH:
        return None
    words = [w.strip(".,;:!?()\"'«»").lower() for w in text.split()]
    return True if sum(w in STOP_WORDS for w in words) >= STOP_SHARE * len(words) else None


def nearest(first: list[bool | None], groups: list[int]) -> list[tuple[bool, ...]]:
    """Labels of the nearest decided blocks of each block's group: of both sides if they are equally far, of none if there are none."""
    def distances(places) -> list[tuple[int, bool] | None]:
        last, out = {}, [None] * len(first)
        for i in places:
            if groups[i] in last:
                j = last[groups[i]]
                out[i] = abs(i - j), first[j]
            if first[i] is not None:
                last[groups[i]] = i
        return out
    sides = zip(distances(range(len(first))), distances(range(len(first) - 1, -1, -1)))
    found = [[s for s in both if s] for both in sides]
    return [tuple(kept for d, kept in both if d == min(both)[0]) for both in found]


def main_text(page: str | None) -> str:
    """The main text of a page: a line per block that is in."""
    blocks = [(b, t) for b in blocks_of(page or "") if (t := " ".join("".join(b.parts).split()))]
    first = [label(b, t) for b, t in blocks]
    own, whole, some = nearest(first, [b.container for b, _ in blocks]), nearest(first, [0] * len(blocks)), any(first)
    out = []
    for kept, (b, t), inside, around in zip(first, blocks, own, whole):
        if kept is None and inside:
            kept = any(inside) if b.container else all(inside)
        if kept is None:  # an article in which no block is decided; else the page's blocks, or one of ambiguous blocks alone
            kept = b.container > 0 or (all(around) if around else not some)
        if kept:
            out.append(t)
    return "\n".join(out)


SCHEMA = "page_id long, url string, text string, n_chars long"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(p.as_py()) for p in b.column(2)]
        yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                              ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """A row per page; pages are parsed whole, one at a time, without a shuffle."""
    return pages.selectExpr(f"cast(`{page_id}` as long)", f"`{url}`", f"`{page}`").mapInArrow(_extract, SCHEMA)
