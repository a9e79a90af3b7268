"""Composed datasets, models and reports on generated series."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.operators import explore, models
from tickspark.plans import datasets
from tickspark.sources.sinks import read_json

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def trades(spark):
    """600 trades one second apart for each of two symbols."""
    rng = np.random.default_rng(1)
    rows = []
    for s in ("AAA", "BBB"):
        walk = 100 * np.exp(np.cumsum(rng.normal(0, 1e-3, 600)))
        rows += [
            (s, T0 + dt.timedelta(seconds=i), i, float(walk[i]), 1 + (i % 10) * 0.1, i % 3 != 0) for i in range(600)
        ]
    schema = "symbol string, ts timestamp_ntz, trade_id bigint, price double, qty double, is_buyer_maker boolean"
    return spark.createDataFrame(rows, schema)


def test_full_chain(trades):
    out = datasets.trade_features(trades, "1s", (5, 15), (5, 30), advanced=True)
    assert out.count() == 1200
    assert {"vol_sum_5", "toxicity_15", "y_ret_5", "y_dir_30"} <= set(out.columns)
    row = out.agg(F.min("y_dir_5").alias("lo"), F.max("y_dir_5").alias("hi")).first()
    assert (row["lo"], row["hi"]) == (-1, 1)


def test_written_dataset(spark, trades, tmp_path):
    path = str(tmp_path / "d")
    meta = datasets.trade_dataset(trades, path, "1s", (5, 15), (5, 30), embargo=20)
    n = 570
    te, w = int(n * 0.7), int(n * 0.15)
    assert meta["n_train"] == 2 * te and meta["n_val"] == 2 * w and meta["n_test"] == 2 * (n - te - w - 40)
    assert "y_ret_5" in meta["label_columns"] and "vol_sum_5" in meta["feature_columns"]
    both = datasets.trade_dataset(trades, str(tmp_path / "x"), "1s", (5,), (5,), target="AAA")
    assert "close_bbb" in both["feature_columns"]


def test_training_set_and_baseline(spark, trades):
    data = datasets.trade_training_set(trades, "1s", 5, 1.0, (5, 15), val=0.2)
    assert data.df.where(F.greatest(*[F.col(c).isNull().cast("int") for c in data.features]) > 0).isEmpty()
    last = data.df.groupBy("symbol", "split").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()
    at = {(r["symbol"], r["split"]): r for r in last}
    assert at["AAA", "train"]["hi"] < at["AAA", "val"]["lo"]
    model, metrics = datasets.experiment(data, "logistic", max_iter=20)
    row = metrics.first()
    assert 0 <= row["accuracy"] <= 1 and 0 <= row["auc"] <= 1 and row["n_features"] == len(data.features)
    top = model.importance(spark, 5).collect()
    assert len(top) == 5 and top[0]["importance"] >= top[-1]["importance"]
    three = datasets.trade_training_set(trades, "1s", 5, 1.0, (5,), test=0.1, embargo=5)
    assert {r[0] for r in three.df.select("split").distinct().collect()} == {"train", "val", "test"}
    assert three.summary().count() == 3


def test_book_dataset(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        mid = 100 + float(np.sin(i / 9)) + float(rng.normal(0, 0.01))
        gap = 30 if i >= 200 else 0
        rows.append(("X", T0 + dt.timedelta(seconds=i + gap), mid - 0.5, mid + 0.5, 1.0 + i % 5, 2.0, 1.0))
    rows.append(("X", T0 + dt.timedelta(seconds=9999), 5.0, 4.0, 1.0, 1.0, 1.0))
    book = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, bid_px double, ask_px double, bid_qty double, ask_qty double, vol_base double")
    path = str(tmp_path / "b")
    data = datasets.book_dataset(book, path, min_segment=50, windows=(5, 15), horizons=(5, 10), embargo_s=10)
    train = data.part("train").agg(F.avg("mid").alias("m"), F.stddev_pop("mid").alias("s")).first()
    assert train["m"] == pytest.approx(0, abs=1e-9) and train["s"] == pytest.approx(1)
    assert data.df.select("segment_id").distinct().count() == 2
    report = read_json(spark, f"{path}/validation_report")
    assert report["total_rows"] == 401 and report["dropped_crossed"] == 1 and report["dt_anomalies"] == 1
    assert read_json(spark, f"{path}/metadata")["n_train"] == data.part("train").count()


@pytest.fixture(scope="module")
def logs(spark):
    rng = np.random.default_rng(4)
    walk = 50 * np.exp(np.cumsum(rng.normal(0, 2e-3, 400)))
    updates = [("X", T0 + dt.timedelta(seconds=i), i % 3, float(i % 5), 1.0, 2.0, 3.0) for i in range(0, 400, 2)]
    fills = [("X", T0 + dt.timedelta(seconds=i), "BUY" if i % 2 else "SELL", float(i % 4), float(walk[i])) for i in range(400)]
    return (
        spark.createDataFrame(updates, "symbol string, ts timestamp_ntz, strategy_id bigint, filled_qty double, remaining_qty double, open_qty double, new_open_qty double"),
        spark.createDataFrame(fills, "symbol string, ts timestamp_ntz, side string, fill_qty double, fill_price double"),
    )


def test_price_move_dataset_is_sane(logs):
    data = datasets.price_move_set(*logs, "1s", 5)
    pdf = data.df.orderBy("ts").toPandas()
    assert {"ts", "mid", "future_mid", "ret_h", "y"} <= set(pdf.columns)
    assert pdf["ts"].is_monotonic_increasing
    assert np.allclose(pdf["future_mid"][:-5], pdf["mid"].shift(-5)[:-5])
    assert np.allclose(pdf["ret_h"], pdf["future_mid"] / pdf["mid"] - 1)
    want = np.where(pdf["ret_h"] > 5e-4, 1, np.where(pdf["ret_h"] < -5e-4, -1, 0))
    assert (pdf["y"] == want).all() and pdf["y"].nunique() >= 2
    assert np.isfinite(pdf[list(data.features)].to_numpy(dtype=float)).all()
    assert np.corrcoef(pdf["mid"], pdf["future_mid"])[0, 1] > 0.5
    assert datasets.price_move_set(*logs, "1s", 5, limit_rows=50).df.count() == 50


def test_execution_dataset(logs):
    data = datasets.execution_set(*logs, "1s", 2)
    assert data.df.where("will_fill IS NULL").isEmpty()
    assert "total_fill_qty" in data.features and "will_fill" not in data.features


@pytest.fixture(scope="module")
def learnable(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        a, b = map(float, rng.normal(size=2))
        rows.append(("X" if i % 2 else "Y", i, a, b, int(a + 0.2 * b > 0), 2 * a - b, int(np.digitize(a, [-0.5, 0.5])), "train" if i < 450 else "val"))
    return spark.createDataFrame(rows, "symbol string, ts int, a double, b double, label int, target double, three int, split string")


@pytest.mark.parametrize("kind, params", [("logistic", {}), ("random_forest", {"trees": 10}), ("gbt", {"trees": 5, "max_depth": 3})])
def test_classifiers_learn(spark, learnable, kind, params):
    train, val = learnable.where("split = 'train'"), learnable.where("split = 'val'")
    model = models.fit(train, ["a", "b"], "label", kind, validation=val if kind == "gbt" else None, **params)
    row = model.evaluate(val).first()
    assert row["accuracy"] > 0.85 and row["auc"] > 0.9
    assert model.importance(spark).first()["feature"] == "a"
    scored = model.score(val)
    assert scored.where((F.col("p_1") > 0.5) != (F.col("prediction") == 1)).isEmpty()


def test_three_classes_and_regression(learnable):
    train, val = learnable.where("split = 'train'"), learnable.where("split = 'val'")
    assert models.fit(train, ["a", "b"], "three", "logistic").evaluate(val).first()["accuracy"] > 0.8
    assert models.fit(train, ["a", "b"], "target", "ridge").evaluate(val).first()["r2"] > 0.95
    assert models.fit(train, ["a", "b"], "target", "random_forest", regression=1, trees=10).evaluate(val).first()["r2"] > 0.7
    assert models.fit(train, ["a", "b"], "target", "gbt", regression=1, trees=10).evaluate(val).first()["r2"] > 0.7
    with pytest.raises(ValueError):
        models.fit(train, ["a", "b"], "three", "gbt")
    with pytest.raises(ValueError):
        models.fit(train.where("label = 1"), ["a"], "label")


def test_each_symbol(learnable):
    rows = models.per_symbol(learnable.withColumn("label", F.when(F.col("symbol") == "Y", 1).otherwise(F.col("label"))), ["a", "b"], symbols=["X", "Y"]).collect()
    got = {r["symbol"]: r["accuracy"] for r in rows}
    assert got["X"] > 0.8 and got["Y"] is None


def test_reports(spark, learnable):
    rows = learnable.select(F.col("ts").cast("bigint").alias("ts_ms"), F.col("target").alias("y_ret_5"), F.col("label").alias("y_dir_5"), F.abs("target").alias("y_vol_5"))
    parts = [rows.where(F.col("ts_ms").between(lo, hi)) for lo, hi in ((0, 299), (310, 449), (460, 599))]
    out = datasets.split_reports(*parts)
    assert out["quality"].count() == 3
    assert out["compare"].first()["gap_train_to_val"] == 11
    names = {(r["target"], r["metric"]) for r in out["targets"].collect()}
    assert {("y_ret_5", "mse_pred0"), ("y_vol_5", "mae_predmean"), ("y_dir_5", "acc_majority"), ("y_ret_5", "q99")} <= names
    panels = explore.panel_columns(learnable.withColumn("close", F.lit(1.0)))
    assert panels == {"Price": ["close"], "Label": ["label"]}
