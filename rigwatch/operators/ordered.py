"""Ordered operators that never sort a whole key group in one task.

Every function cuts a key group into time blocks, works inside the blocks and
carries a bounded summary from block to block. Only the summaries, one or a
few rows per block, are ordered per key. ``forward_fill``,
``over_previous_rows`` and ``merge_runs`` take window tables, with one row per
key and time: a block then holds at most block length / window slide rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigwatch.functions.columns import block_of
from rigwatch.session import materialise

DAY = timedelta(days=1)


def with_index(df: DataFrame, keys: Sequence[str], time_col: str, tie: str, name: str = "sample_idx",
               kind: str = "int") -> DataFrame:
    """Add the 0-based position of each row inside its key group, by time then ``tie``.

    Rows are range-partitioned on keys, time and ``tie``, which splits a group of any size evenly,
    and written once, so counting and numbering see the same ranges. Rows are numbered inside their
    range; the counts of earlier ranges, a few rows per range, are added. Rows with NULL keys or
    times are numbered like others, NULL first. A position that does not fit ``kind`` is an error.
    """
    ranged = materialise(df.repartitionByRange(*keys, time_col, tie).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_range").alias("_own"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_range").orderBy(time_col, tie)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("_range") == F.col("_own"))
    return (
        ranged.withColumn("_place", F.row_number().over(inside) - 1).join(offsets, on)
        .withColumn(name, (F.col("_offset") + F.col("_place")).cast(kind))
        .drop("_range", "_own", "_offset", "_place", *[f"_{k}" for k in keys])
    )


def forward_fill(df: DataFrame, keys: Sequence[str], time_col: str, columns: Sequence[str],
                 suffix: str = "_interpolated", block: timedelta = DAY) -> DataFrame:
    """Last non-NULL value at or before each row, per column.

    NULL keys make a group like others; rows without a time keep their own values.
    """
    blocked = df.withColumn("_block", block_of(time_col, block))
    last_in_block = blocked.groupBy(*keys, "_block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(time_col))).alias(f"_last_{c}") for c in columns])
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last_in_block.select(
        *[F.col(k).alias(f"_{k}") for k in [*keys, "_block"]],
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in columns])
    inside = (Window.partitionBy(*keys, "_block").orderBy(time_col)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*keys, "_block"]])
    filled = blocked.join(carried, on).withColumns({
        f"{c}{suffix}": F.when(F.col(time_col).isNull(), F.col(c))
        .otherwise(F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"_carry_{c}")))
        for c in columns})
    return filled.drop("_block", "__block", *[f"_{k}" for k in keys], *[f"_carry_{c}" for c in columns])


def over_previous_rows(df: DataFrame, keys: Sequence[str], time_col: str, columns: Sequence[str],
                       rows: int, results: dict, block: timedelta = DAY) -> DataFrame:
    """Window expressions that look back at most ``rows`` rows.

    ``results`` maps a new column to a function from a window spec to an
    expression over ``columns``. Each block is preceded by copies of the last
    ``rows`` rows before it, so the spec can stay inside the block.
    """
    blocked = df.withColumn("_block", block_of(time_col, block))
    needed = list(dict.fromkeys([time_col, *columns]))
    from_end = Window.partitionBy(*keys, "_block").orderBy(F.col(time_col).desc())
    tails = (
        blocked.select(*keys, "_block", *needed)
        .withColumn("_from_end", F.row_number().over(from_end))
        .filter(F.col("_from_end") <= rows)
    )
    by_time = Window.partitionBy(*keys).orderBy(time_col)
    copies = (
        tails
        .withColumn("_before", F.collect_list(F.struct(*needed)).over(by_time.rowsBetween(-rows, -1)))
        .withColumn("_new", F.coalesce(F.lag("_block").over(by_time) != F.col("_block"), F.lit(False)))
        .filter("_new")
        .select(*keys, "_block", F.inline("_before"))
    )
    named = blocked.withColumn("_copy", F.lit(False)).unionByName(
        copies.withColumn("_copy", F.lit(True)), allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_block").orderBy(time_col)
    return (
        named.withColumns({name: build(inside) for name, build in results.items()})
        .filter(~F.col("_copy"))
        .drop("_block", "_copy")
    )


def rate_of_change(df: DataFrame, keys: Sequence[str], time_col: str, column: str,
                   name: str, seconds: float = 1.0, block: timedelta = DAY) -> DataFrame:
    """Difference to the previous row per ``seconds``; NULL on the first row of a key."""
    return over_previous_rows(
        df, keys, time_col, [column], 1,
        {name: lambda w: (F.col(column) - F.lag(column, 1).over(w)) / F.lit(float(seconds))}, block)


def rolling_mean(df: DataFrame, keys: Sequence[str], time_col: str, column: str,
                 name: str, rows: int = 6, block: timedelta = DAY) -> DataFrame:
    """Mean over the current row and the ``rows - 1`` rows before it."""
    return over_previous_rows(
        df, keys, time_col, [column], rows - 1,
        {name: lambda w: F.avg(column).over(w.rowsBetween(-(rows - 1), Window.currentRow))}, block)


def merge_runs(df: DataFrame, keys: Sequence[str], start: str, end: str, state: str,
               block: timedelta = DAY) -> DataFrame:
    """Merge consecutive rows of equal state into intervals.

    Runs are built inside each block. Only the first and last run of a block
    can continue in a neighbour, so only those are merged across blocks.
    """
    inside = Window.partitionBy(*keys, "_block").orderBy(start)
    runs = (
        df.select(*keys, start, end, state, block_of(start, block).alias("_block"))
        .withColumn("_new", (~F.lag(state).over(inside).eqNullSafe(F.col(state))).cast("int"))
        .withColumn("_run", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_block", "_run", state)
        .agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("n_rows"))
    )
    edges = Window.partitionBy(*keys, "_block")
    marked = runs.withColumn(
        "_edge", (F.col("_run") == F.min("_run").over(edges)) | (F.col("_run") == F.max("_run").over(edges)))
    # Read by both branches below: computed once through the reused exchange.
    inner = marked.filter(~F.col("_edge")).select(*keys, state, start, end, "n_rows")
    across = Window.partitionBy(*keys).orderBy(start)
    joined = (
        marked.filter("_edge")
        .withColumn("_new", (
            ~F.lag(state).over(across).eqNullSafe(F.col(state))
            | F.lag("_block").over(across).eqNullSafe(F.col("_block"))).cast("int"))
        .withColumn("_run", F.sum("_new").over(across.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_run", state)
        .agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("n_rows").alias("n_rows"))
        .select(*keys, state, start, end, "n_rows")
    )
    return inner.unionByName(joined)


def newest(df: DataFrame, order: Sequence[str], n: int = 2) -> DataFrame:
    """The n newest rows; each task keeps n candidates."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def newest_first(time_col: str, tie: str) -> Column:
    """Time and tie-break as one number, so that ``max_by`` stays in a hash aggregation."""
    micros = F.unix_micros(F.col(time_col).cast("timestamp")).cast("decimal(18,0)")
    return (micros * F.lit("1" + "0" * 19).cast("decimal(20,0)") + F.coalesce(F.col(tie).cast("decimal(19,0)"), F.lit(-1))).cast("decimal(38,0)")


def latest_by(df: DataFrame, keys: Sequence[str], order: Column, columns: Sequence[str]) -> DataFrame:
    """Per key the values of the row that comes last in ``order``.

    Column by column, so that plain numbers and times stay in a hash
    aggregation; a struct in the buffer would sort the input instead.
    """
    return df.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in columns])
