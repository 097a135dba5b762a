from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rigwatch.operators import ordered

T0 = pd.Timestamp(datetime(2024, 1, 1))


def make(spark, n=900, seed=0, nulls=0.5):
    """Irregular times over many blocks; one key holds a third of the rows, some blocks are empty."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "key": np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 6, n)).astype("int32"),
        "ts": T0 + pd.to_timedelta(rng.permutation(n * 40)[:n], unit="min"),
        "v": rng.normal(0, 10, n).round(3), "w": rng.normal(5, 2, n).round(3)})
    pdf.loc[rng.random(n) < nulls, "v"] = np.nan
    df = spark.createDataFrame(pdf).repartition(7)
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return df, pdf.sort_values(["key", "ts"]).reset_index(drop=True)


def back(df):
    return df.toPandas().sort_values(["key", "ts"]).reset_index(drop=True)


@pytest.mark.parametrize("block", [timedelta(hours=3), timedelta(days=1), timedelta(days=400)])
def test_forward_fill(spark, block):
    df, pdf = make(spark)
    got = back(ordered.forward_fill(df, ["key"], "ts", ["v"], block=block))
    np.testing.assert_allclose(got["v_interpolated"].astype(float), pdf.groupby("key")["v"].ffill())
    assert len(got) == len(pdf)


@pytest.mark.parametrize("block", [timedelta(hours=3), timedelta(days=1), timedelta(days=400)])
def test_rate_and_rolling_mean(spark, block):
    df, pdf = make(spark, nulls=0.0)
    rate = back(ordered.rate_of_change(df, ["key"], "ts", "w", "rate", 2.0, block))
    np.testing.assert_allclose(rate["rate"].astype(float), pdf.groupby("key")["w"].diff() / 2.0)
    rolled = back(ordered.rolling_mean(df, ["key"], "ts", "w", "rolled", 6, block))
    want = pdf.groupby("key")["w"].rolling(6, min_periods=1).mean().reset_index(drop=True)
    np.testing.assert_allclose(rolled["rolled"].astype(float), want)


def test_index_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, T0.to_pydatetime(), 1.0), (None, None, 2.0), (1, None, 3.0)], "key int, ts timestamp_ntz, w double")
    assert {r.w: r.sample_idx for r in ordered.with_index(df, ["key"], "ts", "w").collect()} == {2.0: 0, 1.0: 1, 3.0: 0}


def test_index(spark):
    df, pdf = make(spark)
    got = back(ordered.with_index(df, ["key"], "ts", "w"))
    assert (got["sample_idx"] == pdf.groupby("key").cumcount()).all()


def test_index_breaks_ties(spark):
    df = spark.createDataFrame([(1, T0.to_pydatetime(), w) for w in (3.0, 1.0, 2.0)], "key int, ts timestamp_ntz, w double")
    got = {r.w: r.sample_idx for r in ordered.with_index(df, ["key"], "ts", "w").collect()}
    assert got == {1.0: 0, 2.0: 1, 3.0: 2}


@pytest.mark.parametrize("hours", [1, 2, 24, 10_000])
def test_runs_merge_across_blocks(spark, hours):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame([(k, T0 + pd.Timedelta(minutes=10 * n), s)
                        for k, p in (("steady", 0.0), ("flaky", 0.5), ("rare", 0.03))
                        for n, s in enumerate((rng.random(400) < p).astype(int))], columns=["key", "start", "state"])
    df = spark.createDataFrame(pdf).withColumn("start", F.col("start").cast("timestamp_ntz")).withColumn(
        "end", F.col("start") + F.lit(timedelta(minutes=10)))
    got = ordered.merge_runs(df, ["key"], "start", "end", "state", timedelta(hours=hours)).toPandas()
    got = got.sort_values(["key", "start"]).reset_index(drop=True)
    pdf = pdf.sort_values(["key", "start"])
    run = ((pdf.state != pdf.state.shift()) | (pdf.key != pdf.key.shift())).cumsum()
    want = pdf.groupby(run).agg(key=("key", "first"), state=("state", "first"), start=("start", "min"), n_rows=("state", "size"))
    want = want.sort_values(["key", "start"]).reset_index(drop=True)
    assert got[["key", "state", "n_rows"]].values.tolist() == want[["key", "state", "n_rows"]].values.tolist()
    assert (got["start"].values == want["start"].values.astype(got["start"].dtype)).all()


def test_latest_and_newest(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 3, 7.0), ("b", 2, 1.0)], "k string, o int, v double")
    assert sorted(tuple(r) for r in ordered.latest_by(df, ["k"], F.col("o"), ["o", "v"]).collect()) == [("a", 3, 7.0), ("b", 2, 1.0)]
    assert [r.o for r in ordered.newest(df, ["o"], 2).collect()] == [3, 2]
