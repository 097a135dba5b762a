"""Connected components of a link table by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigwatch.session import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(links: DataFrame, kept: Scratch | None = None) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``) that isn't its component's smallest one.

    Alternates large-star and small-star rounds, each a join and a combining aggregation whose
    result is written once; the number of rounds grows with the logarithm of the longest chain.
    A round turns each link into one link, so none adds rows; links that became equal go at the end.
    What a round wrote is deleted after the next; the last result goes with ``kept``, else when the session ends.
    """
    pair = [F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")]
    last = Scratch(links.sparkSession)
    edges = last.write(links.where(F.col("a") != F.col("b")).select(*pair).distinct(), "links")
    state = _state(edges)
    while True:
        old, last = last, Scratch(links.sparkSession)
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = old.write(both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")), "large-star")
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo"))
        edges, before = last.write(small, "small-star"), state
        old.drop()
        state = _state(edges)
        if state == before:
            if kept:
                kept.paths += last.paths
            return edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root"))  # one root each
