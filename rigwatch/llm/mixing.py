"""Mixing sources to target weights by capped water-filling.

Every source has a weight. The level of the water is a number of words per unit of weight; a
source takes the level times its weight, but at most ``epochs`` times its own size. What a full
source cannot take raises the level for the others, until none is above its cap. Sources then
repeat their documents: a whole number of times each, and once more for those with the lowest
seeded hashes until the fraction is met.

Defined results: null source is a source of its own; null or negative sizes count as 0; a source
without words gets target 0; if all sources are full the rest of the budget is left; rows that
are equal in the hashed columns are repeated alike; an empty table gives an empty plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigwatch.session import materialise

BUCKET_BITS = 12


def draw(columns: Sequence[str | Column], seed: int = 29) -> Column:
    """Non-negative 63-bit hash that orders the documents of a source."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in columns]), 1)


def water_level(sources: DataFrame, budget: float, epochs: float) -> float:
    """Words per unit of weight at which the capped sources take ``budget`` together.

    Each round clamps the sources above their cap and shares what they leave among the others
    by weight; the level only rises, so it ends after at most as many rounds as sources.
    ``sources`` has ``weight`` and ``source_size``.
    """
    cap = F.col("source_size") * F.lit(float(epochs))
    level, clamped = 0.0, -1
    while True:
        full = cap < F.col("weight") * F.lit(level)
        n, taken, open_weight = sources.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight").cast("double"))), F.lit(0.0))).first()
        if open_weight <= 0:
            return float("inf")
        if n <= clamped:
            return level
        level, clamped = (budget - taken) / open_weight, n


def mix_plan(docs: DataFrame, weights: DataFrame, share: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """Plan per source: ``source, source_size, target, whole, last``.

    ``docs`` has ``source, size, draw``; ``weights`` has ``source, weight``. A document is taken
    ``whole`` times, and once more if its draw is at most ``last``. The words taken differ from
    the target by at most about one document. A source may hold most of the rows: only sums per
    hash bucket and the rows of one bucket out of 4096 are ordered.
    """
    size = F.greatest(F.coalesce(F.col("size"), F.lit(0)), F.lit(0))
    bucket = F.shiftright("draw", 63 - BUCKET_BITS).cast("int")
    slim = materialise(docs.select("source", size.alias("size"), "draw", bucket.alias("bucket")), "mix-docs")
    sums = slim.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    buckets = materialise(sums, "mix-buckets")
    totals = materialise(buckets.groupBy("source").agg(F.sum("size").alias("source_size"))
                         .join(weights.select(F.col("source").alias("w_source"), "weight"),
                               F.col("source").eqNullSafe(F.col("w_source"))).drop("w_source"), "mix-sources")
    budget = share * (totals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level = water_level(totals, budget, epochs)
    cap = F.col("source_size") * F.lit(float(epochs))
    plan = totals.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)) if level != float("inf") else cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.floor(ratio).cast("long"))
    plan = materialise(plan.withColumn("quota", F.col("target") - F.col("whole") * F.col("source_size")), "mix-plan")

    # The bucket in which a source's running size passes its quota, then the document in it.
    run = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
    slice_ = plan.select(F.col("source").alias("p_source"), "quota")
    edge = (buckets.withColumn("run", run).join(slice_, F.col("source").eqNullSafe(F.col("p_source")))
            .where((F.col("run") - F.col("size") <= F.col("quota")) & (F.col("quota") < F.col("run")))
            .select("p_source", F.col("bucket").alias("p_bucket"), (F.col("quota") - F.col("run") + F.col("size")).alias("rest")))
    in_edge = slim.join(edge, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("bucket") == F.col("p_bucket")))
    inside = F.sum("size").over(Window.partitionBy("p_source").orderBy("draw"))
    lasts = (in_edge.select("p_source", "draw", "rest", (inside - F.col("size") / 2).alias("middle"))
             .groupBy("p_source").agg(F.max(F.when(F.col("middle") < F.col("rest"), F.col("draw"))).alias("inner")))
    lasts = (edge.select(F.col("p_source").alias("e_source"), "p_bucket")
             .join(lasts, F.col("e_source").eqNullSafe(F.col("p_source")), "left")
             .select("e_source", F.coalesce("inner", F.shiftleft(F.col("p_bucket").cast("long"), 63 - BUCKET_BITS) - 1).alias("edge_last")))
    whole = (plan.join(lasts, F.col("source").eqNullSafe(F.col("e_source")), "left")
             .select("source", "source_size", "target", "whole",
                     F.coalesce("edge_last", F.when(F.col("quota") > 0, F.lit((1 << 63) - 1)).otherwise(F.lit(-1))).alias("last")))
    return materialise(whole, "mix-final")  # its size is known to the joins that apply it


def repetitions(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` (with ``source`` and ``draw``) with ``source_size``, ``target`` and ``repeats`` of the plan."""
    p = plan.select(F.col("source").alias("_plan_source"), "source_size", "target", "whole", "last")
    return (docs.join(p, F.col("source").eqNullSafe(F.col("_plan_source")))
            .withColumn("repeats", F.col("whole") + F.when(F.col("draw") <= F.col("last"), 1).otherwise(0))
            .drop("_plan_source", "whole", "last"))


def cyclic_weights(docs: DataFrame, pattern: Sequence[int] = (5, 2, 1)) -> DataFrame:
    """A weight per source: the pattern, repeated, over the distinct sources by code point, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(w) for w in pattern])
    return docs.select("source").distinct().withColumn("weight", F.get(values, F.pmod(place, F.lit(len(pattern)))))
