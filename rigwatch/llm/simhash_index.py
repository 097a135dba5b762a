"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints are indexed as a hierarchy of masked bit patterns. The upper nodes are patterns over
fixed bit masks, chosen so that two fingerprints within the radius share at least one of them; they
are rows of a table, and a node that is too full is refined to longer masks. Below a node its
fingerprints are sorted by Gray rank and grouped by eights; each group factors out the bits that all
its members share, and a search drops whole groups once the differences gathered on the way down
pass the radius. Linked fingerprints are joined to components by star contraction.

Defined results: texts without words (null, empty, white space) have fingerprint 0, linked like any
other; equal texts share a fingerprint; ``component_id`` is the smallest non-null id of the component,
null if it has none; an empty table gives an empty result; repeated rows each get a row; further
columns are kept, names of the operator start with ``_sim_``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from rigwatch.llm.components import components
from rigwatch.session import Scratch, materialise

SHINGLE = 3
SEED = 42
RADIUS = 2
SEARCHED = 2_000_000 # queries times points of a node at a time
FULL_NODE = 512    # fingerprints below one upper node; fuller ones are refined
FAN = 8
CHUNK = 1 << 15    # shingles hashed at a time
COPY_SHINGLE = 5
COPY_RADIUS = 3    # of the fingerprints of near copies that the index looks up
STARS = 16         # members of a group, other ones by key, with which a turn compares
WIDE_NODE = 8192   # texts of a block of a node, of which all pairs are compared
FEW_TEXTS = 4000   # looked through for common shingles
COMMON = 8         # of those texts with a shingle, or more
MARK_BITS = 24
SKETCHED = 1024    # pairs whose counts are held at a time
SKETCH = 64        # counts of a set, looked at for every two members of a node
WIDE_SKETCH = 1024 # counts of a set, for pairs that the small sketch leaves: it tells long texts apart
TURNS = 4          # of comparing with a few members of a node
STALLED = 0.9      # share of the nodes' pairs that a turn leaves: if it is more, further turns would bring little
FEW = 64           # pairs a row that are compared at once
MANY = 256         # pairs that one copy of a text serves
BROADCAST_IDS = 1 << 20  # ids that are sent to all tasks at most: 8 MB
ROWS = 8192        # rows searched at a time, whole nodes


def _hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of a text, in chunks; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), CHUNK):
        yield np.array([digest(line[a:b], SEED) for a, b in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])], np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the shingles' hashes, as a signed 64-bit integer."""
    return majority(_hashes(text, shingle))


def majority(parts: Iterable[np.ndarray]) -> int:
    ones, n = np.zeros(64, np.int64), 0
    for hashes in parts:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for text in texts:
        yield pd.Series([fingerprint(t) for t in text], dtype="int64")


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "_sim_fp") -> DataFrame:
    return docs.withColumn(name, _fingerprints(F.col(text)))


# Upper nodes: masks ------------------------------------------------------------------------------

def _spread(bits: list[int], parts: int) -> list[int]:
    """The bits dealt into ``parts`` masks."""
    return [sum(1 << b for b in bits[i::parts]) for i in range(parts)]


def top_masks(radius: int = RADIUS) -> list[int]:
    """Pairs of ``radius + 2`` blocks of bits: ``radius`` differing bits leave two blocks equal."""
    cuts = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def finer_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """Masks with one of ``radius + 1`` parts of the free bits added: ``radius`` differing bits leave a part equal."""
    free = [b for b in range(64) if not mask >> b & 1]
    return list(dict.fromkeys(mask | part for part in _spread(free, radius + 1)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _under(points: DataFrame, masks: list[tuple[int | None, int]]) -> DataFrame:
    """A row per point and mask; a mask with a parent is for the points of the parent's nodes."""
    spark = points.sparkSession
    m = spark.createDataFrame([(None if p is None else _signed(p), _signed(c)) for p, c in masks], "parent long, child long")
    if masks[0][0] is None:
        return points.select("*", F.explode(F.array(*[F.lit(_signed(c)) for _, c in masks])).alias("mask")).select(
            *POINT, "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
    return (points.join(F.broadcast(m), F.col("mask") == F.col("parent"))  # masks: a number fixed by the method
            .select(*POINT, F.col("child").alias("mask"), F.col("fp").bitwiseAND(F.col("child")).alias("value")).distinct())


POINT = ["id", "fp"]


def links(points: DataFrame, radius: int = RADIUS, kept: Scratch | None = None) -> DataFrame:
    """``a, b``: ids linking all points (different ``id, fp``) whose ``fp`` are within the radius, as stars per node.

    They are found as the result is read, from nodes written to ``kept`` (else they stay till the session ends).
    """
    points, kept = points.select(*POINT), kept or Scratch(points.sparkSession)
    masks = [(None, m) for m in top_masks(radius)]
    rows, ready = _under(points, masks), []
    while True:
        step = Scratch(points.sparkSession)
        rows = step.write(rows, "sim-nodes")
        sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sized = kept.write(rows.join(sizes, ["mask", "value"]), "sim-sized")
        step.drop()
        ready.append(sized.where(F.col("n") <= FULL_NODE).drop("n"))
        full = sized.where(F.col("n") > FULL_NODE).drop("n")
        if full.isEmpty():
            break
        masks = [(m, c) for m in dict.fromkeys(c for _, c in masks) for c in finer_masks(m, radius)]
        rows = _under(full, masks)
    found = [r.repartition("mask", "value").sortWithinPartitions("mask", "value").select("mask", "value", *POINT)
             .mapInArrow(_search_nodes(radius), "a long, b long") for r in ready]
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out.distinct()


# Lower nodes: Gray order -------------------------------------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Groups of eight neighbours in Gray order, and groups of those, for the rows of many nodes.

    ``node`` ascends; rows of a node are in Gray order. Every level keeps what the members share.
    """

    def __init__(self, node: np.ndarray, fp: np.ndarray):
        ands, ors, nodes, self.parents = [fp], [fp], [node], []
        while True:
            first = np.flatnonzero(np.r_[True, nodes[-1][1:] != nodes[-1][:-1]])
            sizes = np.diff(np.r_[first, len(nodes[-1])])
            if len(first) == len(nodes[-1]):
                break
            inside = np.arange(len(nodes[-1])) - np.repeat(first, sizes)
            starts = np.flatnonzero(inside % FAN == 0)
            self.parents.append(np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(nodes[-1])])))
            ands.append(np.bitwise_and.reduceat(ands[-1], starts))
            ors.append(np.bitwise_or.reduceat(ors[-1], starts))
            nodes.append(nodes[-1][starts])
        self.fp, self.ands, self.shared = fp, ands, [~(x ^ y) for x, y in zip(ands, ors)]
        self.root = np.searchsorted(nodes[-1], node)
        self.starts = [np.searchsorted(p, np.arange(len(a))) for p, a in zip(self.parents, ands[1:])]

    def pairs(self, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Places within the radius of the queries' rows, in the same node and after the query's own."""
        at = self.root[query]
        gone = np.bitwise_count((self.fp[query] ^ self.ands[-1][at]) & self.shared[-1][at]).astype(np.int16)
        for level in range(len(self.parents) - 1, -1, -1):
            counts = np.diff(np.r_[self.starts[level], len(self.parents[level])])[at]
            child = np.repeat(self.starts[level][at] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
            query, gone, above = np.repeat(query, counts), np.repeat(gone, counts), np.repeat(at, counts)
            fresh = self.shared[level][child] & ~self.shared[level + 1][above]  # bits that the parent didn't share
            gone = gone + np.bitwise_count((self.fp[query] ^ self.ands[level][child]) & fresh)
            keep = gone <= radius
            query, at, gone = query[keep], child[keep], gone[keep]
        half = query < at
        return query[half], at[half]


def linked_pairs(node: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of one node within the radius."""
    return GrayIndex(node, fp).pairs(np.arange(len(fp)), radius)


def _stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place in the component of every place."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _search_nodes(radius: int):
    """Star links of the nodes in ``mask, value, id, fp`` rows that come sorted by node."""
    def linked(mask, value, ids, fp):
        order = np.lexsort((gray_rank(fp.view(np.uint64)), value, mask))
        mask, value, ids, fp = (c[order] for c in (mask, value, ids, fp))
        u = fp.view(np.uint64)
        node = np.cumsum(np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
        cuts = [0]
        for end in np.flatnonzero(np.r_[node[1:] != node[:-1], True]) + 1:
            if end - cuts[-1] >= ROWS or end == len(node):
                cuts.append(int(end))
        for s, e in zip(cuts, cuts[1:]):
            index, star = GrayIndex(node[s:e], u[s:e]), np.arange(e - s)
            step = max(1, SEARCHED // int(np.bincount(node[s:e] - node[s]).max()))
            for q in range(0, e - s, step):
                a, b = index.pairs(np.arange(q, min(q + step, e - s)), radius)
                star = _stars(e - s, star[a], star[b])[star]
            own = np.flatnonzero(star != np.arange(e - s))
            if len(own):
                yield pa.record_batch([pa.array(ids[s:e][own]), pa.array(ids[s:e][star[own]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 4
        for batch in batches:
            rows = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
            if not len(rows[0]):
                continue
            last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])  # the last node may go on
            done = len(last) - int(last.sum())
            held = [c[done:] for c in rows]
            if done:
                yield from linked(*[c[:done] for c in rows])
        if len(held[0]):
            yield from linked(*held)
    return run


# Documents ---------------------------------------------------------------------------------------

def with_component(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` (with ``_sim_fp``) and ``component_id``. ``docs`` is read twice: pass a written table."""
    points = materialise(docs.groupBy(F.col("_sim_fp").alias("fp")).agg(F.min(doc_id).alias("low")), "sim-points")
    roots = components(links(points.select(F.col("fp").alias("id"), "fp")))
    rooted = points.join(roots, points.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.min("fp").alias("_sim_root"))
    named = rooted.select("fp", "root").join(lows, "root").select("fp", "component_id", "_sim_root")
    return docs.join(named, F.col("_sim_fp") == F.col("fp")).drop("fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint`` (hex), ``component_id``; equal rows get equal values."""
    slim = with_component(materialise(with_fingerprint(docs, text).drop(text), "sim-docs"), doc_id)
    return slim.withColumn("fingerprint", F.lower(F.lpad(F.hex("_sim_fp"), 16, "0"))).drop("_sim_fp", "_sim_root")


# Documents with one of each group of near copies ---------------------------------------------------

def shingle_set(text: str | None) -> np.ndarray:
    """The different five-word shingles of a text, as ascending 64-bit hashes."""
    parts = list(_hashes(text, COPY_SHINGLE))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def near_copies(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles have a Jaccard similarity of 0.8 or more."""
    small, large = sorted((len(a), len(b)))
    if small * 5 < large * 4:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * 5 >= (len(a) + len(b) - both) * 4


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Range of each shingle's hash, once a text."""
    for batch in batches:
        for text in batch.column(0):
            yield pa.record_batch([pa.array(np.unique(shingle_set(text.as_py()) >> np.uint64(64 - MARK_BITS)).astype(np.int64))], ["mark"])


def _common(texts: DataFrame) -> bytes:
    """Marks of the ranges of hashes with shingles that many texts have, from a few texts: it's for speed only."""
    few = texts.where(F.rand(SEED) < F.lit(FEW_TEXTS / max(1, texts.count())))
    often = few.mapInArrow(_shingles, "mark long").groupBy("mark").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= COMMON)
    marks = np.zeros(1 << MARK_BITS, np.uint8)  # a fixed size, however many there are
    marks[[r.mark for r in often.toLocalIterator()]] = 1
    return np.packbits(marks).tobytes()


def _counts(hashes: np.ndarray, buckets: int) -> bytes:
    return np.minimum(np.bincount((hashes % np.uint64(buckets)).astype(np.int64), minlength=buckets), 255).astype(np.uint8).tobytes()


def _described(common: bytes):
    """``doc_id, id, set, n, fp, sketch, wide, prefix`` of ``doc_id, id, text``.

    ``fp`` is the SimHash fingerprint of the set. ``prefix`` has a set's first shingles, one more than may be missing: sets with a similarity of 0.8 share
    one of those, in whatever order that is the same for all sets. Shingles in ``common`` ranges come last,
    so that a common passage makes a node only for texts that are little else. ``sketch`` and ``wide`` count the shingles
    by bits of their hashes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.unpackbits(np.frombuffer(common, np.uint8))
        for batch in batches:
            names, sizes, prints, sketches, wides, prefixes = [], [], [], [], [], []
            for text in batch.column(2):
                s = shingle_set(text.as_py())
                n = len(s)
                names.append(xxhash.xxh128_hexdigest(s.tobytes()))
                sizes.append(n)
                prints.append(majority(s[i:i + CHUNK] for i in range(0, n, CHUNK)))
                sketches.append(_counts(s, SKETCH))
                wides.append(_counts(s >> np.uint64(8), WIDE_SKETCH))
                order = np.argsort(last[s >> np.uint64(64 - MARK_BITS)], kind="stable")
                prefixes.append(s[order[:n - (4 * n + 4) // 5 + 1 if n else 0]].view(np.int64))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(sizes, pa.int64()),
                                   pa.array(prints, pa.int64()), pa.array(sketches, pa.binary()), pa.array(wides, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                                  ["doc_id", "id", "set", "n", "fp", "sketch", "wide", "prefix"])
    return run


def _alike(n: str, m: str) -> Column:
    return F.least(n, m) * 5 >= F.greatest(n, m) * 4


def _shared(points: DataFrame, kept: Scratch) -> DataFrame:
    """``key, id, n, pos`` of the prefix shingles that several points (``id, n, prefix``) have."""
    step = Scratch(points.sparkSession)
    keys = step.write(points.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "copy-keys")
    keyed = points.select("id", "n", F.posexplode("prefix").alias("pos", "key")).select("key", "id", "n", F.col("pos").cast("long").alias("pos"))
    nodes = kept.write(keyed.join(keys, "key", "left_semi"), "copy-nodes")
    step.drop()
    return nodes


def _sketches(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(len(batch), -1).astype(np.int16)


def _node_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``a, b`` of each node that may be near copies, from ``key, i, j, block, id, n, pos, root, sketch`` sorted by node."""
    def pairs(key, i, j, block, ids, n, pos, root, sketch):
        node = np.cumsum(np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        at, step = np.arange(len(node)), 0
        while len(at):
            step += 1
            at = at[at + step < len(node)]
            at = at[node[at] == node[at + step]]
            x, y = at, at + step
            once = (i[x] == j[x]) | (block[x] != block[y])  # two blocks: only pairs across
            most = np.minimum(n[x] - pos[x], n[y] - pos[y])  # shared from the first shared shingle on
            ok = once & (root[x] != root[y]) & (5 * np.minimum(n[x], n[y]) >= 4 * np.maximum(n[x], n[y])) & (9 * most >= 4 * (n[x] + n[y]))
            x, y = x[ok], y[ok]
            ok = 9 * np.abs(sketch[x] - sketch[y]).sum(axis=1) <= n[x] + n[y]
            if ok.any():
                yield pa.record_batch([pa.array(np.minimum(ids[x[ok]], ids[y[ok]])), pa.array(np.maximum(ids[x[ok]], ids[y[ok]]))], ["a", "b"])
    held = [np.empty(0, np.int64)] * 8 + [np.empty((0, SKETCH), np.int16)]
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns[:8]] + [_sketches(batch, "sketch")]
        rows = [np.concatenate([h, c]) for h, c in zip(held, columns)]
        if not len(rows[0]):
            continue
        last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) & (rows[2] == rows[2][-1])  # the last node may go on
        done = len(last) - int(last.sum())
        held = [c[done:] for c in rows]
        if done:
            yield from pairs(*[c[:done] for c in rows])
    if len(held[0]):
        yield from pairs(*held)


def _all_pairs(rest: DataFrame, points: DataFrame) -> DataFrame:
    """``a, b``: all pairs of the nodes' rows with different roots; wide nodes are cut to blocks, a task has two of them."""
    blocks = F.ceil(F.col("c") / F.lit(WIDE_NODE))
    rest = rest.select("key", "c", "id", "n", "pos", "root").join(points.select("id", "sketch"), "id")
    rows = rest.select("key", "id", "n", "pos", "root", "sketch", blocks.alias("blocks"), F.pmod(F.xxhash64("id"), blocks).alias("block"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "n", "pos", "root", "sketch")
    return (rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(_node_pairs, "a long, b long").distinct())


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of ``a, part, b, text`` sorted by block, in which the text of ``a`` itself (no ``b``) comes first."""
    own = None
    for batch in batches:
        found: tuple[list, list] = [], []
        for a, b, text in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("text")):
            if b is None:
                own = shingle_set(text.as_py())
            elif near_copies(own, shingle_set(text.as_py())):
                found[0].append(a)
                found[1].append(b)
        yield pa.record_batch([pa.array(c, pa.int64()) for c in found], ["a", "b"])


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches leave a similarity of 0.8 possible: their differences are differing shingles."""
    for batch in (b.slice(i, SKETCHED) for b in batches for i in range(0, b.num_rows, SKETCHED)):
        if batch.num_rows:
            x, y = (_sketches(batch, c) for c in ("sketch_a", "sketch_b"))
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            ok = pa.array(9 * np.abs(x - y).sum(axis=1) <= n)
            yield pa.record_batch([batch.column("a").filter(ok), batch.column("b").filter(ok)], ["a", "b"])


def _with_counts(pairs: DataFrame, points: DataFrame, column: str) -> DataFrame:
    """Pairs that the counts in ``column`` leave possible."""
    for end in ("a", "b"):
        pairs = pairs.join(points.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"), F.col(column).alias(f"sketch_{end}")), end)
    return pairs.mapInArrow(_sketched, "a long, b long")


def _sent(ids: DataFrame) -> DataFrame:
    """Written ids, sent to all tasks unless there are many: those meet the texts in a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _verified(pairs: DataFrame, points: DataFrame, texts: DataFrame, kept: Scratch, one: bool = False, tested: bool = False) -> DataFrame:
    """The pairs whose texts are near copies, by all of their shingles; of ``one``, a pair per ``b`` that sketches allow.

    ``tested`` pairs have passed the small sketch already.
    A text ``a`` is sent once to each block of its partners, and a partner's once to the block.
    """
    step = Scratch(texts.sparkSession)
    pairs = step.write(pairs if tested else _with_counts(pairs, points, "sketch"), "copy-candidates")
    pairs = _with_counts(pairs, points, "wide")
    if one:
        pairs = pairs.groupBy("b").agg(F.min(F.struct(F.xxhash64("a").alias("h"), "a")).alias("m")).select("m.a", "b")
    pairs = step.write(pairs, "copy-pairs")
    ids = step.write(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "copy-ids")
    held = step.write(texts.join(_sent(ids), "id", "left_semi"), "copy-texts")
    blocks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(MANY)).alias("parts"))
    placed = step.write(pairs.join(blocks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), "b"), "copy-blocks")
    partners = placed.join(held, placed.b == held.id).select("a", "part", "b", "text")
    stars = placed.select("a", "part").distinct().join(held, F.col("a") == held.id).select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    rows = stars.union(partners).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").isNotNull())
    links = kept.write(rows.select("a", "b", "text").mapInArrow(_compare, "a long, b long"), "copy-links")
    step.drop()
    return links


def indexed_links(points: DataFrame, texts: DataFrame, kept: Scratch) -> DataFrame:
    """``a, b``: links found through the Gray-order index of the points' fingerprints (``fp``), verified on the texts.

    A fingerprint is indexed once, by its smallest id; its other ids are candidates of that one.
    """
    firsts = kept.write(points.groupBy("fp").agg(F.min("id").alias("first")), "copy-prints")
    near = links(firsts.select(F.col("first").alias("id"), "fp"), COPY_RADIUS, kept)
    same = points.join(firsts, "fp").where(F.col("id") != F.col("first")).select(F.col("first").alias("a"), F.col("id").alias("b"))
    pairs = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().union(same)
    return _verified(pairs, points, texts, kept)


def copy_links(nodes: DataFrame, points: DataFrame, texts: DataFrame, kept: Scratch) -> DataFrame:
    """``a, b``: ids that link all points with a similarity of 0.8 or more, directly or through others.

    First come the links through the Gray-order index. Similar texts whose fingerprints differ by more than its radius
    meet in nodes, one of a shingle: the texts of a node that are still apart are compared with a few members of it, and what
    that links needs no further comparing; once such turns stall, all pairs of a node that are still apart. ``nodes`` has ``key, id, n, pos``,
    ``points`` ``id, n, fp, sketch, wide``, ``texts`` ``id, text``; all are read several times.
    """
    def rooted(rows: DataFrame) -> DataFrame:
        roots = components(found, turns[-1])
        return turns[-1].write(rows.join(roots, rows.id == roots.node, "left").select(*nodes.columns, F.coalesce("root", "id").alias("root")), "copy-rooted")

    found, turns = indexed_links(points, texts, kept), [Scratch(nodes.sparkSession)]
    rest, before = rooted(nodes), float("inf")
    for turn in range(TURNS + 1):
        turns.append(Scratch(nodes.sparkSession))
        star = F.min(F.struct(F.xxhash64("id", F.lit(turn), F.col("key").bitwiseAND(STARS - 1)), "id", "n", "root")).alias("star")
        mixed = rest.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi"), star).where("lo <> hi")
        mixed = turns[-1].write(mixed.select("key", "c", "star"), "copy-mixed")
        rest = turns[-1].write(rest.join(mixed, "key"), "copy-rest")
        for done in turns[:-1]:
            done.drop()
        pairs = mixed.agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs"), F.sum("c").alias("rows")).first()
        if not pairs.rows or pairs.pairs <= FEW * pairs.rows or pairs.pairs > STALLED * before or turn == TURNS:
            break
        before = pairs.pairs
        apart = rest.where((F.col("root") != F.col("star.root")) & _alike("n", "star.n"))
        new = _verified(apart.select(F.col("star.id").alias("a"), F.col("id").alias("b")).distinct(), points, texts, kept, one=True)
        found = found.union(new)
        rest = rooted(rest.drop("c", "star", "root"))
    found = found.union(_verified(_all_pairs(rest, points), points, texts, kept, tested=True))
    turns[-1].drop()
    return found


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` less all but one document of each group: the smallest id stays, of equal ids any one.

    Documents are linked if the Jaccard similarity of their sets of five-word shingles is 0.8 or more. Candidates
    come from the Gray-order index of the sets' fingerprints, then, for what its radius leaves apart, from shingles: every
    such pair shares one of its sets' first shingles (see ``_described``), so none is missed, and every link is
    verified on whole sets. Shingles are known by 64-bit hashes, equal sets by 128-bit ones. A text of fewer
    than five words is one shingle; texts without words are one group.
    """
    kept, work = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    rows = kept.write(docs.withColumn("_sim_row", F.monotonically_increasing_id()), "sim-docs")
    texts = rows.select(F.col("_sim_row").alias("id"), F.col(text).alias("text"))
    kinds = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, id long, set string, n long, fp long, sketch binary, wide binary, prefix array<long>"
    slim = rows.select(F.col(doc_id).alias("doc_id"), F.col("_sim_row").alias("id"), F.col(text).alias("text"))
    step = Scratch(docs.sparkSession)
    whole = step.write(slim.mapInArrow(_described(_common(texts.select("text"))), kinds), "sim-described")
    slim = work.write(whole.drop("prefix", "wide", "fp"), "sim-sets")
    first = work.write(slim.groupBy("set").agg(F.min("id").alias("id")), "sim-first")
    points = work.write(whole.select("id", "n", "fp", "sketch", "wide").join(first.select("id"), "id", "left_semi"), "sim-points")
    nodes = _shared(whole.select("id", "n", "prefix").join(first.select("id"), "id", "left_semi"), work)
    step.drop()
    roots = components(copy_links(nodes, points, texts, work), work)
    rooted = first.join(roots, first.id == roots.node, "left").select("set", F.coalesce("root", "id").alias("root"))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "id")
    best = slim.select("doc_id", "id", "set").join(rooted, "set").groupBy("root").agg(F.min(rank).alias("k")).select(F.col("k.id").alias("_sim_kept"))
    best = kept.write(best, "sim-kept")
    work.drop()
    return rows.join(_sent(best), F.col("_sim_row") == F.col("_sim_kept"), "left_semi").select(*docs.columns)
