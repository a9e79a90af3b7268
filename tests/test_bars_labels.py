"""Bars, labels, splits and scaling on hand-made frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickspark.functions.expr import EPS_BARS, epoch_to_ts, interval_micros, parse_ts
from tickspark.operators import bars, labels, scaling, splits, windows

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def trades(spark):
    """60 trades one second apart, price rising by 0.1, sides alternating."""
    rows = [("X", at(i), i, 100 + 0.1 * i, 1.0, i % 2 == 0) for i in range(60)]
    return spark.createDataFrame(
        rows, "symbol string, ts timestamp_ntz, trade_id bigint, price double, qty double, is_buyer_maker boolean"
    )


def test_six_bars(trades):
    out = bars.flow_bars(trades, "10s").orderBy("ts").collect()
    assert len(out) == 6
    first = out[0]
    assert (first["open"], first["num_trades"], first["volume"]) == (100.0, 10, 10.0)
    assert first["close"] == pytest.approx(100.9)
    assert first["vwap"] == pytest.approx(100.45)
    assert first["log_return"] == pytest.approx(math.log(100.9 / 100.0))
    assert all(-1 <= r["volume_imbalance"] <= 1 for r in out)
    assert first["volume_imbalance"] == pytest.approx(0.0, abs=EPS_BARS)


def test_without_symbol(trades):
    out = bars.ohlcv_bars(trades.drop("symbol"), "1m", by=[]).collect()
    assert len(out) == 1 and out[0]["num_trades"] == 60


def test_zero_quantity_has_no_vwap(trades):
    out = bars.ohlcv_bars(trades.withColumn("qty", F.lit(0.0)), "1m").first()
    assert out["vwap"] is None and out["volume"] == 0


def test_ties_are_broken_by_id(spark):
    rows = [("X", at(0), i, float(p), 1.0) for i, p in ((3, 30), (1, 10), (2, 20))]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, trade_id bigint, price double, qty double")
    out = bars.ohlcv_bars(df, "1s").first()
    assert (out["open"], out["close"]) == (10.0, 30.0)


def test_week_and_month_buckets(trades):
    week = bars.ohlcv_bars(trades, "1w").first()
    month = bars.ohlcv_bars(trades, "1mo").first()
    assert week["ts"] == T0 and month["ts"] == T0  # 1 January 2024 is a Monday
    with pytest.raises(ValueError):
        bars.ohlcv_bars(trades, "1 parsec")


def test_twap_weights_time(spark):
    rows = [("X", at(0), 1, 10.0), ("X", at(8), 2, 20.0), ("X", at(10), 3, 30.0)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, trade_id bigint, price double")
    out = bars.twap_bars(df, "10s").orderBy("ts").collect()
    assert out[0]["twap"] == pytest.approx((10 * 8 + 20 * 2) / 10)
    assert out[1]["twap"] == pytest.approx(30.0)


def test_null_strategy_counts_as_one(spark):
    rows = [("X", at(0), 1.0, 1, True, 5.0), ("X", at(0), 2.0, None, None, 6.0)]
    df = spark.createDataFrame(
        rows,
        "symbol string, timestamp timestamp_ntz, signal_value double, strategy_id bigint, entry_allowed boolean, mid_price double",
    )
    out = bars.signal_bars(df, "1s", order=("timestamp", "signal_value")).first()
    assert (out["n_strategies"], out["n_entries_allowed"], out["last_signal"]) == (2, 1, 2.0)


def test_last_labels_are_null(trades):
    flow = bars.flow_bars(trades, "1s")
    out = labels.add_direction_labels(labels.add_return_labels(flow, [5]), [5]).orderBy("ts").collect()
    assert [r["y_ret_5"] is None for r in out] == [False] * 55 + [True] * 5
    assert [r["y_dir_5"] is None for r in out] == [False] * 55 + [True] * 5
    assert {r["y_dir_5"] for r in out[:55]} <= {-1, 0, 1}
    assert out[0]["y_ret_5"] == pytest.approx(math.log(out[5]["close"] / out[0]["close"]))


def test_volatility_label(trades):
    out = labels.add_volatility_labels(bars.flow_bars(trades, "2s"), [3]).orderBy("ts").collect()
    r = [x["log_return"] for x in out]
    assert out[0]["y_vol_3"] == pytest.approx(math.sqrt(sum(v * v for v in r[1:4])))
    assert out[-3]["y_vol_3"] is None and out[-4]["y_vol_3"] is not None


def test_label_choice(spark):
    df = spark.createDataFrame([("X", i, float(i), i % 3) for i in range(9)], "symbol string, ts int, close double, n_fills int")
    auto = labels.create_labels(df, "auto", 2).orderBy("ts").collect()
    assert [r["label"] for r in auto] == [1] * 7 + [None] * 2
    price = labels.create_labels(df, "price_direction", 2).orderBy("ts").collect()
    assert [r["label"] for r in price] == [1] * 7 + [None] * 2
    with pytest.raises(ValueError):
        labels.create_labels(df, "nonsense")
    with pytest.raises(ValueError):
        labels.create_labels(df.select("symbol", "ts"), "auto")


def test_labels_do_not_cross_symbols(spark):
    df = spark.createDataFrame([(s, i, 1.0 + i) for s in "AB" for i in range(4)], "symbol string, timestamp int, price double")
    out = labels.training_labels(df, "direction", 2).collect()
    assert sum(r["label"] is None for r in out) == 4


def test_split_with_embargo(spark):
    df = spark.range(1000).select(F.lit("X").alias("symbol"), F.col("id").alias("ts"))
    sizes = {r["split"]: (r["n"], r["lo"], r["hi"]) for r in splits.split_rows(df).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")
    ).collect()}
    assert sizes == {"train": (700, 0, 699), "val": (150, 760, 909), "test": (30, 970, 999)}


def test_emptied_validation_still_keeps_the_embargo(spark):
    rows = [("X", 1, at(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "symbol string, segment_id int, ts timestamp_ntz")
    out = splits.split_segments(df, embargo_s=4).collect()
    last_train = max(r["ts"] for r in out if r["split"] == "train")
    assert not [r for r in out if r["split"] == "val"]
    test = [r["ts"] for r in out if r["split"] == "test"]
    assert test and min(test) > last_train + dt.timedelta(seconds=4)


def test_segment_split_breaks_ties(spark):
    rows = [("X", 1, at(0), i) for i in reversed(range(20))]
    df = spark.createDataFrame(rows, "symbol string, segment_id int, ts timestamp_ntz, seq int")
    out = splits.split_segments(df, embargo_s=0, order=["seq"]).collect()
    assert [r["split"] for r in sorted(out, key=lambda r: r["seq"])] == ["train"] * 14 + ["val"] * 3 + ["test"] * 3


def test_time_split_keeps_at_least_one(spark):
    df = spark.range(3).select(F.col("id").alias("ts"))
    out = {r["ts"]: r["split"] for r in splits.split_time(df, 0.01).collect()}
    assert out == {0: "train", 1: "train", 2: "val"}


def test_hash_split_ignores_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "ts")
    one = {r["ts"] for r in splits.split_hash(df.repartition(7), ["ts"]).where("split = 'val'").collect()}
    two = {r["ts"] for r in splits.split_hash(df.coalesce(1), ["ts"]).where("split = 'val'").collect()}
    assert one == two and 300 < len(one) < 500


def test_constant_column_is_divided_by_one(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "a double, b double")
    for method in ("standard", "robust", "minmax", "scale_only"):
        s = scaling.fit_scaler(df, ["a", "b"], method)
        assert s.scale[1] == 1.0
        assert all(math.isfinite(v) for r in s.transform(df).collect() for v in r)
    with pytest.raises(ValueError):
        scaling.fit_scaler(df, ["a"], "nonsense")


def test_scaler_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0)], "a double, b double")
    s = scaling.fit_scaler(df, ["b", "a"], "robust")
    s.save(spark, str(tmp_path / "scaler"))
    assert scaling.Scaler.load(spark, str(tmp_path / "scaler")) == s


def test_sequences(spark):
    df = spark.createDataFrame([("X", i, float(i), 10.0 * i, i % 2) for i in range(6)], "symbol string, ts int, a double, b double, label int")
    out = windows.sequences(df, ["a", "b"], length=3).orderBy("ts").collect()
    assert [r["ts"] for r in out] == [3, 4, 5]
    assert out[0]["sequence"] == [[0.0, 0.0], [1.0, 10.0], [2.0, 20.0]]
    assert out[0]["label"] == 1


def test_epoch_units(spark):
    row = spark.range(1).select(
        epoch_to_ts(F.lit(1704067200123), F.lit(dt.date(2024, 12, 31))).alias("ms"),
        epoch_to_ts(F.lit(1735689600123456), F.lit(dt.date(2025, 1, 1))).alias("us"),
        epoch_to_ts(F.lit(1735689600123), F.lit(dt.date(2025, 1, 1)), "um").alias("um"),
        parse_ts(F.lit("2024-01-02 03:04:05.678")).alias("text"),
        parse_ts(F.lit("yesterday")).alias("bad"),
    ).first()
    assert row["ms"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert row["us"] == row["um"] == dt.datetime(2025, 1, 1, 0, 0, 0, 123000)
    assert row["text"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert row["bad"] is None
    assert interval_micros("100ms") == 100_000
