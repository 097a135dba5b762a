"""Removal of repeated substrings by a sparse, hash-compared suffix sort.

Every stretch of ``length`` bytes that starts anywhere else as well is removed, overlaps included.

*Anchors.* A stretch is known by its anchor: of the ``K``-byte words inside it the one with the
smallest hash (the leftmost, if several). Equal stretches have equal anchors at equal offsets, so
only occurrences of one anchor word need comparing; about one position in 70 is an anchor.
Each occurrence owns the stretches whose anchor it is: those that start ``lo`` to ``hi`` bytes
before it. Anchor words that occur once in the corpus end here, by a combining aggregation.

*Suffix sort.* The others are brought together by anchor word, each with the bytes its stretches
span; equal spans are folded. Prefix polynomial hashes of the spans give the common extension of any
two, to the right and to the left of the anchor, by binary search; with it a mergesort orders the
suffixes at the anchors, and the prefixes before them, in a logarithmic number of hash comparisons
each. Neighbours in the suffix order give the classes that share ``t`` bytes to the right; neighbours
in prefix order inside a class give the longest common bytes to the left; both together say which
stretches of an occurrence start elsewhere too. What the hashes call equal is verified byte by byte,
and a node with a collision is sorted again by its bytes.

*Hot anchor words* (more than ``NODE`` occurrences) are split by the hash of each owned stretch
instead, and only counted, so no task holds all their occurrences.

Defined results: null texts are empty; texts shorter than ``length`` lose nothing; a text that
occurs twice loses all; repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigwatch.session import materialise, scratch_path

LENGTH = 200
K = 32
REACH = LENGTH - K        # largest offset of an anchor in its stretch
NODE = 8192               # occurrences of an anchor word sorted in one task
SORT_ROWS = 4096          # spans sorted at a time, whole nodes
BUFFER = 1 << 20          # bytes looked at at a time
FOLD = 100_000            # spans folded in a task at a time

_PLACE = np.uint64(BUFFER - 1)
_ODD = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.r_[np.uint64(1), np.full(BUFFER, _ODD, np.uint64)])
_INVERSE = np.cumprod(np.r_[np.uint64(1), np.full(BUFFER, pow(_ODD, -1, 1 << 64), np.uint64)])


# Anchors -----------------------------------------------------------------------------------------

def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """``text, place, hash, lo, hi`` of all anchors, texts in turn, in buffers of bounded size."""
    pieces, size, out = [], 0, []
    for i, t in enumerate(texts):
        for s in range(0, max(len(t) - LENGTH + 1, 0), BUFFER // 2):
            piece = t[s:s + BUFFER // 2 + LENGTH - 1]
            if size + len(piece) > BUFFER:
                out.append(_anchors(pieces))
                pieces, size = [], 0
            pieces.append((i, s, piece))
            size += len(piece)
    if pieces:
        out.append(_anchors(pieces))
    if not out:
        return tuple(np.empty(0, k) for k in (np.int64, np.int64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out))


def _anchors(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
    ends = np.cumsum([len(p) for _, _, p in pieces])
    starts = np.r_[0, ends[:-1]]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS[:len(data)], out=sums[1:])
    n = len(data) - K + 1
    h = (sums[K:] - sums[:-K]) * _INVERSE[:n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    low = (h & ~_PLACE) | np.arange(n, dtype=np.uint64)  # smallest hash, then leftmost
    width, step = REACH + 1, 1
    while step * 2 <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if width > step:
        low = np.minimum(low[:step - width], low[width - step:])
    at = (low & _PLACE).astype(np.int64)  # anchor of the stretch starting here
    piece = np.searchsorted(ends, np.arange(len(at)), side="right")
    whole = np.arange(len(at)) + LENGTH <= ends[piece]
    first = np.flatnonzero(whole & np.r_[True, (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])])
    last = np.flatnonzero(whole & np.r_[(at[1:] != at[:-1]) | (piece[1:] != piece[:-1]) | ~whole[1:], True])
    q, p = at[first], piece[first]
    text = np.array([i for i, _, _ in pieces])
    shift = np.array([s for _, s, _ in pieces]) - starts
    return text[p], q + shift[p], h[q], q - last, q - first


# Nodes: hash-compared suffix sort ----------------------------------------------------------------

class Spans:
    """Spans of the occurrences of anchor words, aligned at the anchor, with their prefix hashes."""

    def __init__(self, spans: list[bytes], hi: np.ndarray):
        n, self.width = len(spans), REACH + LENGTH
        self.rows = np.zeros((n, self.width), np.uint16)  # bytes plus 1; 0 outside of the span
        for i, (s, h) in enumerate(zip(spans, hi.tolist())):
            self.rows[i, REACH - h:REACH - h + len(s)] = np.frombuffer(s, np.uint8)
            self.rows[i, REACH - h:REACH - h + len(s)] += 1
        sums = np.zeros((n, self.width + 1), np.uint64)
        np.cumsum(self.rows.astype(np.uint64) * _POWERS[:self.width], axis=1, out=sums[:, 1:])
        self.right = sums[:, REACH:] - sums[:, REACH:REACH + 1]                          # of the first t bytes from the anchor
        self.left = sums[:, REACH:REACH + 1] - sums[:, REACH::-1]                        # of the t bytes before it
        self.right_rows, self.left_rows = self.rows[:, REACH:], self.rows[:, :REACH][:, ::-1]

    def extension(self, a: np.ndarray, b: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Longest common extension of spans by binary search on their prefix hashes."""
        lo, hi = np.zeros(len(a), np.int64), np.full(len(a), hashes.shape[1] - 1)
        for _ in range(int(hashes.shape[1]).bit_length()):
            middle = (lo + hi + 1) >> 1
            same = hashes[a, middle] == hashes[b, middle]
            lo, hi = np.where(same, middle, lo), np.where(same, hi, np.maximum(middle - 1, lo))
        return lo

    def before(self, a: np.ndarray, b: np.ndarray, side: str) -> tuple[np.ndarray, np.ndarray]:
        """Whether span ``a`` sorts before ``b`` on a side, and whether they are equal there."""
        hashes, rows = getattr(self, side), getattr(self, side + "_rows")
        t = self.extension(a, b, hashes)
        equal = t == rows.shape[1]
        t = np.minimum(t, rows.shape[1] - 1)
        return rows[a, t] < rows[b, t], equal

    def sort(self, node: np.ndarray, side: str) -> np.ndarray:
        """Order of the spans on a side, node by node: a bottom-up mergesort.

        All runs are merged at once: an element's new place is its own plus the number of elements
        of the sibling run before it, found by binary search.
        """
        n = len(node)
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        sizes = np.diff(np.r_[first, n])
        base, size, order = np.repeat(first, sizes), np.repeat(sizes, sizes), np.arange(n)
        offset, run = np.arange(n) - base, 1
        while run < sizes.max(initial=0):
            number = offset // run
            right = (number & 1).astype(bool)
            sibling = base + (number ^ 1) * run
            length = np.clip(base + size - sibling, 0, run)
            place = base + (number >> 1) * 2 * run + offset % run
            busy = np.flatnonzero(length > 0)
            lo, hi = np.zeros(len(busy), np.int64), length[busy]
            while (open_ := lo < hi).any():
                i = np.flatnonzero(open_)
                middle = (lo[i] + hi[i]) >> 1
                other, own = order[sibling[busy[i]] + middle], order[busy[i]]
                less, equal = self.before(other, own, side)
                go = less | (equal & right[busy[i]])
                lo[i], hi[i] = np.where(go, middle + 1, lo[i]), np.where(go, hi[i], middle)
            place[busy] += lo
            merged = np.empty(n, np.int64)
            merged[place] = order
            order, run = merged, run * 2
        return order

    def verified(self, a: np.ndarray, b: np.ndarray, t: np.ndarray, side: str) -> np.ndarray:
        """Whether the first ``t`` bytes are equal, and the next ones (if any) aren't: no hash collision."""
        rows = getattr(self, side + "_rows")
        differs = rows[a] != rows[b]
        actual = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
        return actual == t


def repeated(node: np.ndarray, spans: list[bytes], lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest offset at which a span's stretch is also another span's; -1 if none is.

    ``node`` ascends; the spans of a node are different from each other.
    """
    s = Spans(spans, hi)
    n = len(node)
    least, most = np.full(n, LENGTH), np.full(n, -1)
    order, prefix = s.sort(node, "right"), s.sort(node, "left")
    same = node[order[1:]] == node[order[:-1]]
    common = np.where(same, s.extension(order[:-1], order[1:], s.right), 0)
    pairs = np.flatnonzero(same)
    if not s.verified(order[pairs], order[pairs + 1], common[pairs], "right").all():
        order = np.array(sorted(range(n), key=lambda i: (node[i], s.right_rows[i].tobytes())))
        differs = s.right_rows[order[1:]] != s.right_rows[order[:-1]]
        common = np.where(same, np.where(differs.any(axis=1), differs.argmax(axis=1), LENGTH), 0)
    rank = np.empty(n, np.int64)
    rank[prefix] = np.arange(n)
    left_size, right_size = hi, LENGTH - lo
    common = np.minimum(common, np.minimum(right_size[order[:-1]], right_size[order[1:]]))
    # For each length t at which two suffixes part, the classes that share t bytes.
    node_of_pair = node[order[:-1]]
    for t in np.unique(common[same & (common >= K)]):
        has = np.isin(node[order], node_of_pair[same & (common == t)])
        cls = np.cumsum(np.r_[0, common < t])
        members = np.flatnonzero(has & (right_size[order] >= t) & (left_size[order] >= LENGTH - t))
        rows, cls = order[members], cls[members]
        by = np.lexsort((rank[rows], cls))
        rows, cls = rows[by], cls[by]
        a, b = rows[:-1], rows[1:]
        together = cls[1:] == cls[:-1]
        a, b = a[together], b[together]
        left = s.extension(a, b, s.left)
        bad = ~s.verified(a, b, left, "left")
        if bad.any():
            differs = s.left_rows[a[bad]] != s.left_rows[b[bad]]
            left[bad] = np.where(differs.any(axis=1), differs.argmax(axis=1), REACH)
        left = np.minimum(left, np.minimum(left_size[a], left_size[b]))
        found = left >= LENGTH - t
        for x in (a[found], b[found]):
            np.maximum.at(most, x, left[found])
            np.minimum.at(least, x, LENGTH - t)
    return np.where(most >= 0, least, -1), most


# Tasks -------------------------------------------------------------------------------------------

_pack, _unpack = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress


def _texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches of about a buffer of text each."""
    for b in batches:
        sizes, at = np.cumsum(np.asarray(b.column("n_bytes"))), 0
        while at < b.num_rows:
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + BUFFER, side="right")))
            part = b.slice(at, to - at)
            yield part, [_unpack(z, max_output_size=1 << 31) for z in part.column(column).to_pylist()]
            at = to


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
        yield pa.record_batch([b.column("tid"), pa.array([len(t) for t in texts], pa.int64()), pa.array(map(_pack, texts), pa.binary())],
                              ["tid", "n_bytes", "packed"])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the anchor words of each text, and how often it has them."""
    for b, texts in _texts(batches, "packed"):
        text, _, h, _, _ = anchors(texts)
        words, counts = [[] for _ in texts], [[] for _ in texts]
        order = np.lexsort((h, text))
        text, h = text[order], h[order]
        new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])]) if len(h) else np.empty(0, np.int64)
        for i, w, c in zip(text[new].tolist(), h[new].view(np.int64).tolist(), np.diff(np.r_[new, len(h)]).tolist()):
            words[i].append(w)
            counts[i].append(c)
        yield pa.record_batch([*[b.column(c) for c in ("tid", "copies", "n_bytes", "packed")],
                               pa.array(words, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32()))],
                              ["tid", "copies", "n_bytes", "packed", "words", "counts"])


def _wanted(part: pa.RecordBatch, texts: list[bytes]):
    """Anchors of the texts whose words are among the repeated ones, with the node's size class."""
    text, place, h, lo, hi = anchors(texts)
    cold, hot = ([np.array(x or [], np.int64) for x in part.column(c).to_pylist()] for c in ("cold", "hot"))
    tid = part.column("tid").to_pylist()
    key = h.view(np.int64)
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        s, e = bounds[i], bounds[i + 1]
        is_cold, is_hot = np.isin(key[s:e], cold[i]), np.isin(key[s:e], hot[i])
        for j in np.flatnonzero(is_cold | is_hot) + s:
            span = texts[i][place[j] - hi[j]:place[j] - lo[j] + LENGTH]
            named = xxhash.xxh3_64_intdigest(span, int(lo[j])) >> 1
            yield tid[i], int(place[j]), int(key[j]), int(lo[j]), int(hi[j]), span, named, bool(is_hot[j - s])


def _spot(tid: bytes, place: int) -> int:
    return xxhash.xxh3_64_intdigest(tid, place) >> 1


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different spans at repeated anchor words, with the smallest and largest spot; hot ones marked."""
    names = ["word", "span_id", "lo", "hi", "span", "first", "last", "hot"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
    held: dict[tuple, list] = {}

    def flush():
        if held:
            columns = zip(*[(*k, *v) for k, v in held.items()])
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            held.clear()

    for part, texts in _texts(batches, "packed"):
        for tid, place, word, lo, hi, span, named, hot in _wanted(part, texts):
            spot = _spot(tid, place)
            row = held.setdefault((word, named, lo, hi), [span, spot, spot, hot])
            row[1], row[2] = min(row[1], spot), max(row[2], spot)
        if len(held) >= FOLD:
            yield from flush()
    yield from flush()


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in _texts(batches, "packed"):
        rows = [(named, word, tid, place) for tid, place, word, _, _, _, named, _ in _wanted(part, texts)]
        if rows:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.int64()))],
                                  ["span_id", "word", "tid", "place"])


def _sort_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, span_id, least, most`` of the spans with repeated stretches, from spans sorted by word and id."""
    def sorted_nodes(rows: list[tuple]):
        folded: dict[tuple, list] = {}
        for word, named, lo, hi, span, first, last in rows:
            row = folded.setdefault((word, named, lo, hi, span), [first, last])
            row[0], row[1] = min(row[0], first), max(row[1], last)
        keys = list(folded)
        word = np.array([k[0] for k in keys])
        lo, hi = np.array([k[2] for k in keys]), np.array([k[3] for k in keys])
        least, most = repeated(np.cumsum(np.r_[0, word[1:] != word[:-1]]), [k[4] for k in keys], lo, hi)
        many = np.array([a != b for a, b in folded.values()])
        least, most = np.where(many, lo, least), np.where(many, hi, most)
        found = np.flatnonzero(most >= 0)
        if len(found):
            yield pa.record_batch([pa.array(word[found]), pa.array([keys[i][1] for i in found]),
                                   pa.array(least[found], pa.int32()), pa.array(most[found], pa.int32())],
                                  ["word", "span_id", "least", "most"])

    held: list[tuple] = []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns]):
            if len(held) >= SORT_ROWS and row[0] != held[-1][0]:
                yield from sorted_nodes(held)
                held = []
            held.append(row)
    if held:
        yield from sorted_nodes(held)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of every owned stretch of hot spans."""
    for b in batches:
        rows = []
        for word, named, lo, hi, span, first, last in zip(*[c.to_pylist() for c in b.columns]):
            for r in range(lo, hi + 1):
                digest = xxhash.xxh3_128_intdigest(span[hi - r:hi - r + LENGTH])
                rows.append((digest >> 65, digest & ((1 << 63) - 1), word, named, r, first, last))
            if len(rows) > 50_000:
                yield _stretch_batch(rows)
                rows = []
        if rows:
            yield _stretch_batch(rows)


def _stretch_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()] + [pa.int64()] * 2
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["h1", "h2", "word", "span_id", "r", "first", "last"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text."""
    for b, texts in _texts(batches, "packed"):
        out = []
        for text, copies, gone in zip(texts, b.column("copies").to_pylist(), b.column("gone").to_pylist()):
            if copies > 1 and len(text) >= LENGTH:
                runs = [(0, len(text))]
            else:
                runs = []
                for g in sorted((g["s"], g["e"]) for g in gone or []):
                    if runs and g[0] <= runs[-1][1]:
                        runs[-1] = (runs[-1][0], max(runs[-1][1], g[1]))
                    else:
                        runs.append(g)
            kept, at = hashlib.sha256(), 0
            for s, e in runs:
                kept.update(text[at:s])
                at = e
            kept.update(text[at:])
            out.append((len(text), sum(e - s for s, e in runs), len(runs), kept.hexdigest()))
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.record_batch([b.column("tid"), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]],
                              ["tid", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


# The job -----------------------------------------------------------------------------------------

def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written as a table bucketed by ``key``, so that later joins on it move the other side only."""
    spark = df.sparkSession
    path = scratch_path(spark, "texts")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", path).option("compression", "none").saveAsTable(name)
    return spark.table(name)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"), F.unhex(F.sha2(whole, 256)).alias("tid"))
    packed = rows.select("tid", "text").mapInArrow(_compress, "tid binary, n_bytes long, packed binary")
    different = packed.groupBy("tid").agg(F.count(F.lit(1)).alias("copies"), F.first("n_bytes").alias("n_bytes"),
                                          F.first("packed").alias("packed"))
    texts = _bucketed(different.mapInArrow(
        _index, "tid binary, copies long, n_bytes long, packed binary, words array<long>, counts array<int>"), "tid")

    # Anchor words found at two places or more, and who has them.
    words = texts.select("tid", F.inline(F.arrays_zip("words", "counts")))
    seen = words.groupBy("words").agg(F.sum("counts").alias("n"))
    again = seen.where("n > 1").select("words", (F.col("n") > NODE).alias("hot"))
    cold = F.collect_list(F.when(~F.col("hot"), F.col("words"))).alias("cold")
    hot = F.collect_list(F.when(F.col("hot"), F.col("words"))).alias("hot")
    flags = materialise(words.select("tid", "words").join(again, "words").groupBy("tid").agg(cold, hot), "repeat-flags")
    flagged = texts.select("tid", "n_bytes", "packed").join(flags, "tid")

    spans = flagged.mapInArrow(_spans, "word long, span_id long, lo int, hi int, span binary, first long, last long, hot boolean")
    spans = materialise(spans, "repeat-spans")
    columns = ["word", "span_id", "lo", "hi", "span", "first", "last"]
    cold_found = (spans.where("not hot").select(*columns).repartition("word").sortWithinPartitions("word", "span_id")
                  .mapInArrow(_sort_nodes, "word long, span_id long, least int, most int"))
    each = spans.where("hot").select(*columns).mapInArrow(
        _stretches, "h1 long, h2 long, word long, span_id long, r int, first long, last long")
    twice = each.groupBy("h1", "h2").agg(F.min("first").alias("a"), F.max("last").alias("b")).where("a <> b").select("h1", "h2")
    hot_found = (each.join(twice, ["h1", "h2"]).groupBy("word", "span_id")
                 .agg(F.min("r").alias("least"), F.max("r").alias("most")))
    found = cold_found.union(hot_found)

    occurrences = flagged.mapInArrow(_occurrences, "span_id long, word long, tid binary, place long")
    gone = (occurrences.join(found, ["word", "span_id"]).groupBy("tid").agg(F.collect_list(F.struct(
        (F.col("place") - F.col("most")).alias("s"), (F.col("place") - F.col("least") + LENGTH).alias("e"))).alias("gone")))
    left = (texts.select("tid", "copies", "n_bytes", "packed").join(gone, "tid", "left")
            .mapInArrow(_cut, "tid binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    return rows.select("doc_id", "tid").join(left, "tid").drop("tid")
