"""Models of all symbols together against a model of each symbol alone."""

import random

import pytest
from pyspark.sql import functions as F

from tickspark.operators import models


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    rows = []
    for name, n in (("A", 400), ("B", 120), (None, 90), ("one", 40)):
        for k in range(n):
            a, b = rng.gauss(0, 1), rng.gauss(0, 3)
            odds = 0.8 * a - 0.3 * b + (0.5 if name == "A" else -0.2) + rng.gauss(0, 1)
            three = float((a + rng.gauss(0, 1) > 0.4) + (b + rng.gauss(0, 1) > 0.8))
            label = 1 if name == "one" else int(odds > 0)
            rows.append((name, a, b, label, three, odds, "val" if k % 4 == 0 else "train"))
    schema = "symbol string, a double, b double, label int, three double, target double, split string"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.mark.parametrize(("kind", "label"), [("logistic", "label"), ("logistic", "three"), ("ridge", "target")])
def test_weights_equal_single_fits(table, kind, label):
    train = table.where("split = 'train'")
    made = {r["symbol"]: r for r in models.fit_symbols(train, ["a", "b"], label, kind).table.collect()}
    names = {"A", "B", None} | ({"one"} if label != "label" else set())
    assert set(made) == names
    for name in names:
        single = models.fit(train.where(F.col("symbol").eqNullSafe(name)), ["a", "b"], label, kind)
        if label == "three":
            want = [[*row, c] for row, c in zip(single.model.coefficientMatrix.toArray().tolist(), single.model.interceptVector.toArray().tolist())]
        else:
            want = [[*single.model.coefficients.toArray().tolist(), single.model.intercept]]
        for got_row, want_row in zip(made[name]["weights"], want):
            assert got_row == pytest.approx(want_row, abs=2e-3)


@pytest.mark.parametrize(("kind", "label"), [("logistic", "label"), ("logistic", "three"), ("ridge", "target")])
def test_metrics_equal_single_fits(table, kind, label):
    rows = {r["symbol"]: r for r in models.per_symbol(table, ["a", "b"], label, kind).collect()}
    assert set(rows) == {"A", "B", None, "one"}
    for name in ("A", "B", None):
        own = table.where(F.col("symbol").eqNullSafe(name))
        want = models.fit(own.where("split = 'train'"), ["a", "b"], label, kind).evaluate(own.where("split = 'val'")).first()
        for c in want.asDict():
            assert rows[name][c] == pytest.approx(want[c], abs=5e-3), (name, c)
    if label == "label":
        assert rows["one"]["accuracy"] is None and rows["one"]["n"] is None


def test_one_job_per_step(spark, table):
    """Steps do not multiply with the symbols."""
    many = table.where("symbol IN ('A', 'B')").crossJoin(spark.range(12)).withColumn("symbol", F.concat("symbol", F.col("id")))
    sc = spark.sparkContext

    def jobs(df):
        sc.setJobGroup("count", "count")
        models.fit_symbols(df.where("split = 'train'"), ["a", "b"])
        done = len(sc.statusTracker().getJobIdsForGroup("count"))
        sc.setJobGroup("rest", "rest")
        return done

    assert jobs(many) <= jobs(table.where("symbol IN ('A', 'B')")) + 4


def test_scores_without_a_model(spark, table):
    made = models.fit_symbols(table.where("split = 'train'"), ["a", "b"])
    other = spark.createDataFrame([("new", 1.0, 2.0), ("A", None, float("nan"))], "symbol string, a double, b double")
    rows = {r["symbol"]: r for r in made.score(other).collect()}
    assert rows["new"]["prediction"] is None and rows["A"]["prediction"] in (0.0, 1.0)
    with pytest.raises(ValueError):
        models.fit_symbols(table, ["a"], kind="gbt")
