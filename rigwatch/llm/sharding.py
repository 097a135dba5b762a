"""Sharding by sampled splitters.

A size-weighted sample of the keys gives quantile boundaries; records are range-partitioned by
them, ranges that turn out overfull are subdivided, and exact sizes of the ranges place every
record on one global line of bytes, which is cut into shards of equal length.

Defined results: a null size counts as 0; null key fields sort first; records equal in all keys
may be cut apart, as may those of a range (no range has to stay whole); records equal in every
column are interchangeable; an empty table gives an empty result; further columns are kept, names
used by the operator itself start with ``_shard_``.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigwatch.session import materialise

SAMPLES_PER_RANGE = 20  # keys drawn for each range
ROWS_PER_RANGE = 1000   # aim; with more rows than MAX_RANGES * ROWS_PER_RANGE the ranges grow
MAX_RANGES = 4096       # bound on the boundaries kept by the driver
OVERFULL = 2.0          # times the mean size or row count


def _uniform(seed: int, columns: Sequence[str]) -> Column:
    """A number in [0, 1) that depends on the columns' values alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]), 11) / F.lit(float(1 << 53))


def splitters(records: DataFrame, keys: Sequence[str], size: str, ranges: int, total: float, seed: int = 17) -> str:
    """Quantile boundaries of a size-weighted key sample, as JSON; at most ``ranges - 1``.

    A record is drawn with a probability in proportion to its size, so equal counts of the
    sample stand for equal bytes. The sample has about ``SAMPLES_PER_RANGE * ranges`` keys.
    """
    rate = ranges * SAMPLES_PER_RANGE / max(total, 1.0)
    drawn = (records.where(_uniform(seed, keys) < F.col(size) * F.lit(rate))
             .select(F.struct(*keys).alias("k")).orderBy("k").select(F.to_json("k", {"ignoreNullFields": "false"}).alias("j")))
    sample = [row.j for row in drawn.collect()]  # bounded by ranges, not by the records
    step = len(sample) / ranges
    picked = [sample[math.floor(i * step)] for i in range(1, ranges)] if sample else []
    return json.dumps([json.loads(j) for j in dict.fromkeys(picked)])


def range_of(records: DataFrame, keys: Sequence[str], boundaries: str) -> Column:
    """Number of boundaries at or below a record's key: its range. A binary search in an array literal."""
    key = F.struct(*keys)
    kind = records.select(key.alias("k")).schema["k"].dataType.simpleString()
    bounds = F.from_json(F.lit(boundaries), f"array<{kind}>")
    n = len(json.loads(boundaries))
    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        right = F.get(bounds, middle) <= key
        return F.when(state["lo"] >= state["hi"], state).otherwise(
            F.when(right, F.struct((middle + 1).alias("lo"), state["hi"].alias("hi")))
            .otherwise(F.struct(state["lo"].alias("lo"), middle.alias("hi"))))

    steps = F.sequence(F.lit(1), F.lit(n.bit_length() + 1))
    return F.aggregate(steps, start, halve, lambda state: state["lo"])


def shard_by_bytes(records: DataFrame, keys: Sequence[str], size: str, shards: int = 8) -> DataFrame:
    """``records`` with ``shard`` (0-based) and ``slot`` (0-based, gapless in each shard), shards near equal in bytes.

    Shards follow key order. A shard's bytes differ from an equal share by less than the largest record.
    """
    size_ = F.coalesce(F.col(size).cast("long"), F.lit(0))
    base = materialise(records.withColumn("_shard_size", size_), "shard-input")
    total, rows = base.agg(F.coalesce(F.sum("_shard_size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = max(2 * shards, min(MAX_RANGES, rows // ROWS_PER_RANGE))
    boundaries = splitters(base, keys, "_shard_size", ranges, total)
    ranged = base.withColumn("_shard_range", range_of(base, keys, boundaries))

    # Overfull ranges are cut by a hash of the whole record. One row per range: bounded by MAX_RANGES.
    mean_bytes, mean_rows = max(total / ranges, 1.0), max(rows / ranges, 1.0)
    load = F.greatest(F.sum("_shard_size") / mean_bytes, F.count(F.lit(1)) / mean_rows)
    parts = (ranged.groupBy("_shard_range").agg(load.alias("load"))
             .select("_shard_range", F.when(F.col("load") > OVERFULL, F.ceil("load")).otherwise(1).alias("_shard_parts")))
    whole = F.xxhash64(*[F.col(c) for c in records.columns])
    celled = (ranged.join(F.broadcast(parts), "_shard_range")
              .withColumn("_shard_part", F.pmod(whole, F.col("_shard_parts"))).drop("_shard_parts"))

    # Exact place of every cell on the line of bytes. Cells: at most about three times MAX_RANGES.
    order = Window.orderBy("_shard_range", "_shard_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = (celled.groupBy("_shard_range", "_shard_part").agg(F.sum("_shard_size").alias("b"), F.count(F.lit(1)).alias("n"))
             .select("_shard_range", "_shard_part", F.coalesce(F.sum("b").over(order), F.lit(0)).alias("_shard_b0"),
                     F.coalesce(F.sum("n").over(order), F.lit(0)).alias("_shard_n0")))
    inside = Window.partitionBy("_shard_range", "_shard_part").orderBy(*keys, whole)
    before = F.col("_shard_b0") + F.sum("_shard_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_shard_size") / 2
    placed = materialise(
        celled.join(F.broadcast(cells), ["_shard_range", "_shard_part"])
        .withColumn("_shard_row", F.col("_shard_n0") + F.row_number().over(inside))
        .withColumn("shard", F.least(F.floor(before * shards / F.lit(float(max(total, 1)))), F.lit(shards - 1)).cast("int"))
        .drop("_shard_range", "_shard_part", "_shard_b0", "_shard_n0", "_shard_size"), "shard-placed")
    firsts = placed.groupBy("shard").agg(F.min("_shard_row").alias("_shard_first"))  # a row per shard
    return (placed.join(F.broadcast(firsts), "shard")
            .withColumn("slot", (F.col("_shard_row") - F.col("_shard_first")).cast("long"))
            .drop("_shard_row", "_shard_first"))
