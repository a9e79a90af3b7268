"""Rolling statistics against pandas, over batch and series borders."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickspark.operators.rolling import Rolling
from tickspark.operators.windows import rolling_flow


@pytest.fixture(params=[7, 10_000])
def batch_rows(spark, request):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(request.param))
    yield
    spark.conf.set(key, before)


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    x = rng.normal(size=300)
    x[rng.random(300) < 0.1] = np.nan
    return pd.DataFrame({"k": rng.choice(list("abc"), 300), "t": np.arange(300), "x": x})


def spark_frame(spark, pdf):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "k string, t bigint, x double")


@pytest.mark.parametrize("min_periods", [None, 1])
def test_against_pandas(spark, frame, batch_rows, min_periods):
    r = Rolling(Window.partitionBy("k").orderBy("t"), min_periods)
    made = {}
    for w in (1, 2, 3, 5, 16, 60):
        made |= {f"sum{w}": r.sum("x", w), f"avg{w}": r.avg("x", w), f"std{w}": r.std("x", w)}
    made["late"] = r.avg("x", 4, back=6)
    got = r.detach(r.attach(spark_frame(spark, frame)).withColumns(made)).toPandas().sort_values("t")
    by = frame.groupby("k")["x"]
    for w in (1, 2, 3, 5, 16, 60):
        for stat, name in (("sum", "sum"), ("mean", "avg"), ("std", "std")):
            want = by.transform(lambda v: getattr(v.rolling(w, min_periods=min_periods or w), stat)())
            np.testing.assert_allclose(got[f"{name}{w}"].astype(float), want, rtol=1e-9, atol=1e-9)
    late = by.transform(lambda v: v.rolling(4, min_periods=min_periods or 4).mean().shift(6))
    np.testing.assert_allclose(got["late"].astype(float), late, rtol=1e-9)


def test_large_values_leave_nothing_behind(spark):
    rows = [("a", i, 1e16 if i == 5 else 1.0) for i in range(60)]
    r = Rolling(Window.partitionBy("k").orderBy("t"))
    made = {"s": r.sum("x", 20), "d": r.std("x", 20)}
    out = r.attach(spark.createDataFrame(rows, "k string, t bigint, x double")).withColumns(made)
    last = out.orderBy(F.desc("t")).first()
    assert last["s"] == 20.0
    assert last["d"] == 0.0


def test_short_windows_use_frames(spark, frame):
    r = Rolling(Window.partitionBy("k").orderBy("t"))
    made = {"s": r.sum("x", 2), "d": r.std("x", 3)}
    out = r.attach(spark_frame(spark, frame)).withColumns(made)
    by = frame.groupby("k")["x"]
    got = out.toPandas().sort_values("t")
    np.testing.assert_allclose(got["s"].astype(float), by.transform(lambda v: v.rolling(2).sum()))
    np.testing.assert_allclose(got["d"].astype(float), by.transform(lambda v: v.rolling(3).std()))


def test_cut_series_give_the_same(spark, small_ranges):
    rows = [("S", i, float(i % 13), float(i % 7 + 1)) for i in range(500)]
    bars = spark.createDataFrame(rows, "symbol string, ts bigint, a double, b double")
    base = bars.select(
        "symbol",
        "ts",
        *[F.col("b").alias(c) for c in ("volume", "num_trades", "close", "open", "high", "low", "vwap")],
        *[F.col("a").alias(c) for c in ("buy_volume", "sell_volume", "buy_trades", "sell_trades", "net_volume")],
        *[F.try_divide("a", "b").alias(c) for c in ("volume_imbalance", "trade_imbalance", "log_return")],
    )
    cut = rolling_flow(base, (5, 15), advanced=True).toPandas().sort_values("ts").reset_index(drop=True)
    spark.conf.set("tickspark.chunkRows", "100000")
    whole = rolling_flow(base, (5, 15), advanced=True).toPandas().sort_values("ts").reset_index(drop=True)
    assert len(cut) == 500
    pd.testing.assert_frame_equal(cut, whole[cut.columns], rtol=1e-9)
