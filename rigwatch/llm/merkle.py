"""Merkle manifest of a dataset: a tree of hashes per group of records, proofs, and their check.

``H`` is the lowercase hex SHA-256 of its inputs joined. A record's leaf is ``H`` of its fields. In
each tree leaves stand in key order; while several nodes remain, every two in a row (at the end
maybe one) become their ``H``. The trees' last nodes, in order of the trees, are the leaves of one
more tree, whose last node is the root of the dataset.

A tree is cut into superblocks of ``2 ** BLOCK_LEVELS`` consecutive nodes. Superblocks are reduced
to one node each, these again, until a node is left per tree; a tier has a row per superblock
of the tier below. Then proofs come down the tiers by a subtree exchange: a superblock's nodes and
the nodes outside that its proofs need (siblings of its own node and of that one's ancestors, with the subroot and the root)
are cogrouped, and one task finishes the local reduction, joins local and outer siblings to proofs
and folds them. A task holds one superblock and a logarithm of nodes; texts are hashed where they are
read and never shuffled.

Defined results: a null field counts as ``-`` and an empty one as ``0:``; a null group comes first, then groups
bytewise; within a group null keys come first, ties stand in order of their leaves and rows equal in
everything are interchangeable, each with a proof of its own place; an empty table gives no rows;
columns that are not named are not part of the manifest, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigwatch.session import materialise

BLOCK_LEVELS = 12     # levels of a superblock: 4,096 nodes
SUBROOT, ROOT = 1 << 20, 1 << 21   # levels of the two targets among a superblock's outer nodes
OUTER = "tree long, block long, level int, side string, hash string"


def field(value: Column) -> Column:
    """A field as a leaf takes it: ``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Iterable[Column]) -> Column:
    """Hash of a record's fields in the order given."""
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# Positions ---------------------------------------------------------------------------------------

def numbered(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``name``, the 0-based place in the order of ``keys`` (nulls first, text bytewise).

    Ties are dealt by a written row number, so that no range of equal keys falls to one task.
    Collects nothing: offsets are a window over a row per partition.
    """
    written = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "manifest-rows")
    order = [*keys, "_row"]
    dealt = materialise(written.repartitionByRange(*order).sortWithinPartitions(*order)
                        .withColumn("_at", F.monotonically_increasing_id()), "manifest-ranges")
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = materialise(dealt.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
                          .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "manifest-offsets")
    return (dealt.withColumn("_part", part).join(offsets, "_part")
            .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_part", "_before", "_at", "_row"))


# Reduction ---------------------------------------------------------------------------------------

def _levels(n: int, levels: int) -> int:
    """Levels that a superblock of a tier with ``n`` nodes is reduced by."""
    return min(levels, (n - 1).bit_length())


def _up(level: list[str]) -> list[str]:
    return [_h(*level[i:i + 2]) for i in range(0, len(level), 2)]


def _tops(levels: int):
    def run(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
        hashes, n = nodes.sort_values("pos")["hash"].tolist(), int(nodes["n"].iloc[0])
        for _ in range(_levels(n, levels)):
            hashes = _up(hashes)
        return pd.DataFrame([(*key, hashes[0], (n - 1 >> levels) + 1)], columns=["tree", "pos", "hash", "n"])
    return run


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", levels))


def _tiers(nodes: DataFrame, biggest: int, levels: int) -> list[DataFrame]:
    """``tree, pos, hash, n`` of every tier from ``nodes`` up to a node per tree."""
    tiers = [nodes]
    while biggest > 1:
        grouped = _blocks(tiers[-1], levels).groupBy("tree", "block")
        tiers.append(materialise(grouped.applyInPandas(_tops(levels), "tree long, pos long, hash string, n long"), "manifest-tier"))
        biggest = (biggest - 1 >> levels) + 1
    return tiers


# Exchange ----------------------------------------------------------------------------------------

def _paths(nodes: pd.DataFrame, levels: int, base: int) -> tuple[pd.DataFrame, list[list[tuple]]]:
    """A superblock's nodes in order and, for each, its siblings inside as (level, side, hash)."""
    nodes = nodes.sort_values("pos", kind="stable")
    level, paths = nodes["hash"].tolist(), [[] for _ in range(len(nodes))]
    for k in range(_levels(int(nodes["n"].iloc[0]), levels)):
        for i, path in enumerate(paths):
            at = i >> k
            other = at ^ 1
            side = "" if other >= len(level) else "L" if other < at else "R"
            path.append((base + k, side, level[other] if side else ""))
        level = _up(level)
    return nodes, paths


def fold(node: str, path: Iterable[tuple]) -> str:
    """The root that a node and its siblings, lowest first, lead to."""
    for _, side, other in path:
        node = _h(other, node) if side == "L" else _h(node, other) if side == "R" else _h(node)
    return node


def _descend(levels: int, base: int, subroots: bool):
    """Outer nodes of every node of a superblock, for the tier below; ``subroots`` adds the node itself as its tree's."""
    def run(key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes, paths = _paths(nodes, levels, base)
        above = list(zip(outer["level"].tolist(), outer["side"].tolist(), outer["hash"].tolist()))
        out = []
        for tree, pos, own, path in zip(nodes["tree"].tolist(), nodes["pos"].tolist(), nodes["hash"].tolist(), paths):
            place = (pos, 0) if subroots else (tree, pos)
            out += [(*place, *step) for step in [*path, *above, *([(SUBROOT, "", own)] if subroots else [])]]
        return pd.DataFrame(out, columns=["tree", "block", "level", "side", "hash"])
    return run


def _finish(levels: int):
    def run(key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes, paths = _paths(nodes, levels, 0)
        steps = sorted(zip(outer["level"].tolist(), outer["side"].tolist(), outer["hash"].tolist()))
        above, (_, _, subroot), (_, _, root) = steps[:-2], *steps[-2:]
        presented = [s if isinstance(s, str) else h for h, s in zip(nodes["hash"], nodes["shown"])]
        folded = [fold(leaf, path + above) for leaf, path in zip(presented, paths)]
        return pd.DataFrame({
            "id": nodes["id"], "leaf": nodes["hash"], "subroot": subroot, "root": root,
            "proof": [[step[2] for step in path + above if step[1]] for path in paths],
            "folded_root": folded, "verified": [f == root for f in folded]})
    return run


def manifest(records: DataFrame, group: str, key: str, leaf_column: str, shown: str, levels: int = BLOCK_LEVELS) -> DataFrame:
    """``id, leaf, subroot, root, proof, folded_root, verified`` of every record.

    ``leaf_column`` and ``shown`` name the record's leaf and the leaf that is presented for the check
    (null: the same); ``proof`` has the siblings from the leaf to the root, as they stand left to right by level.
    """
    slim = records.select(F.col(group).cast("string").alias("grp"), F.col(key).alias("id"),
                          F.col(leaf_column).alias("hash"), F.col(shown).alias("shown"))
    placed = numbered(slim, ["grp", "id", "hash"], "place")
    trees = placed.groupBy("grp").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = materialise(numbered(trees, ["grp"], "tree").withColumnRenamed("grp", "of"), "manifest-trees")
    n_trees, biggest = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    nodes = (placed.join(trees, F.col("grp").eqNullSafe(F.col("of")))
             .select("tree", (F.col("place") - F.col("first")).alias("pos"), "hash", "n", F.col("id").cast("string").alias("id"), "shown"))

    lower = _tiers(nodes.drop("id", "shown"), biggest or 0, levels)
    tops = lower[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "hash", F.lit(n_trees).cast("long").alias("n"))
    upper = _tiers(materialise(tops, "manifest-tops"), n_trees, levels)
    outer = upper[-1].select("tree", F.lit(0).cast("long").alias("block"), F.lit(ROOT).alias("level"), F.lit("").alias("side"), "hash")
    above = [(tier, len(lower) - 1 + i, i == 0) for i, tier in enumerate(upper)]
    if len(upper) > 1:
        above.pop()  # the root alone
    below = [(tier, i, False) for i, tier in enumerate(lower)][1:-1]
    for tier, number, subroots in [*reversed(above), *reversed(below)]:
        step = _descend(levels, number * 64, subroots)
        outer = materialise(_blocks(tier, levels).groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
                            .applyInPandas(step, OUTER), "manifest-outer")
    done = (_blocks(nodes, levels).groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
            .applyInPandas(_finish(levels), "id string, leaf string, subroot string, root string, proof array<string>, "
                                            "folded_root string, verified boolean"))
    return done.withColumn("id", F.col("id").cast(records.schema[key].dataType))
