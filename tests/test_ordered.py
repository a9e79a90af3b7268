"""Cut series give what a plain window gives."""

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickspark.operators.ordered import Ordered, _Cells
from tickspark.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def ticks(spark):
    """One symbol holds most of the rows, times are tied, some values are NULL."""
    rows = []
    for i in range(900):
        symbol = "HOT" if i % 10 else ("A" if i % 20 else None)
        rows.append((symbol, i // 7, i, float((i * 37) % 101), None if i % 5 else float(i)))
    return spark.createDataFrame(rows, "symbol string, ts bigint, id bigint, x double, y double")


def pandas_rows(df):
    return df.toPandas().sort_values("id").reset_index(drop=True)


@given(
    st.lists(st.integers(0, 30), min_size=1, max_size=25),
    st.integers(1, 40),
    st.integers(0, 25),
    st.integers(0, 25),
)
@settings(max_examples=200, deadline=None)
def test_copies_hold_every_neighbour(counts, limit, back, forward):
    cells = _Cells(("k",), counts, limit)
    owner, copies, starts = cells.range_of, cells.copies(back, forward), cells.starts
    row_cell = [c for c, n in enumerate(counts) for _ in range(n)]
    for r in set(owner):
        own = [i for i, c in enumerate(row_cell) if owner[c] == r]
        seen = [i for i, c in enumerate(row_cell) if r in copies[c]]
        assert seen == sorted(seen)
        if own:
            need = range(max(0, own[0] - back), min(len(row_cell), own[-1] + forward + 1))
            assert set(need) <= set(seen)
            assert seen == list(range(seen[0], seen[-1] + 1))
    assert starts[-1] + counts[-1] == sum(counts)


def test_series_is_really_cut(ticks, small_ranges):
    o = Ordered(ticks, ["symbol"], ["ts", "id"])
    assert o.is_cut
    sizes = o.assigned().groupBy("symbol", "__range").count().toPandas()
    hot = sizes[sizes.symbol == "HOT"]
    assert len(hot) > 5
    assert hot["count"].max() < 200


def test_row_frames(ticks, small_ranges):
    def add(df, w):
        return df.withColumns(
            {
                "s": F.sum("x").over(w.rowsBetween(-9, 0)),
                "back": F.lag("id", 12).over(w),
                "ahead": F.lead("id", 25).over(w),
            }
        )

    got = pandas_rows(Ordered(ticks, ["symbol"], ["ts", "id"]).windows(add, back=12, forward=25))
    want = pandas_rows(ticks)
    by = want.groupby("symbol", dropna=False)
    assert len(got) == len(want)
    pd.testing.assert_series_equal(
        got["s"], by["x"].transform(lambda v: v.rolling(10, min_periods=1).sum()), check_names=False
    )
    pd.testing.assert_series_equal(got["back"], by["id"].shift(12), check_names=False)
    pd.testing.assert_series_equal(got["ahead"], by["id"].shift(-25), check_names=False)


def test_running_values(ticks, small_ranges):
    o = Ordered(ticks, ["symbol"], ["ts", "id"])
    want = pandas_rows(ticks)
    by = want.groupby("symbol", dropna=False)
    number = pandas_rows(o.row_number("n"))["n"]
    pd.testing.assert_series_equal(number, by.cumcount() + 1, check_names=False)
    total = pandas_rows(o.running_sum(t=F.col("y")))["t"]
    pd.testing.assert_series_equal(total, by["y"].transform(lambda v: v.fillna(0).cumsum()), check_names=False)
    last = pandas_rows(o.last_known(k=F.col("y")))["k"]
    pd.testing.assert_series_equal(last, by["y"].transform(lambda v: v.ffill()), check_names=False)
    nxt = pandas_rows(o.last_known(ahead=True, k=F.col("y")))["k"]
    pd.testing.assert_series_equal(nxt, by["y"].transform(lambda v: v.bfill()), check_names=False)


@pytest.mark.parametrize("chunk", [40, 2000])
def test_value_ahead_in_one_pass(spark, chunk):
    """No frame ends at the last row: Spark goes through such a frame anew for every row."""
    rows = [("S", None if i < 3 else i // 2, i, float(i) if i % 7 == 3 else None) for i in range(400)] + [("T", 1, 0, None)]
    df = spark.createDataFrame(rows, "symbol string, ts bigint, id bigint, y double")
    out = Ordered(df, ["symbol"], ["ts", "id"], limit=chunk).last_known(ahead=True, k=F.col("y"))
    assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower()
    got = {(r["symbol"], r["id"]): r["k"] for r in out.collect()}
    want = {("S", i): next((float(j) for j in range(i, 400) if j % 7 == 3), None) for i in range(400)}
    assert got == {**want, ("T", 0): None}


def test_one_global_order(ticks, small_ranges):
    o = Ordered(ticks, [], ["id"])
    assert o.is_cut
    assert pandas_rows(o.row_number("n"))["n"].tolist() == list(range(1, 901))
    assert pandas_rows(o.running_sum(t=F.lit(1)))["t"].tolist() == list(range(1, 901))


def test_long_gap_without_values(spark, small_ranges):
    """Ranges without any value pass the earlier one on."""
    rows = [("S", i, 1.0 if i == 3 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "symbol string, ts bigint, v double")
    out = Ordered(df, ["symbol"], ["ts"]).last_known(k=F.col("v")).orderBy("ts").collect()
    assert [r["k"] for r in out] == [None] * 3 + [1.0] * 597


def test_equal_order_values_stay_together(spark, small_ranges):
    """All rows at one time cannot be cut but are still all there."""
    df = spark.createDataFrame([("S", 5, i) for i in range(300)], "symbol string, ts bigint, id bigint")
    out = Ordered(df, ["symbol"], ["ts"]).row_number("n")
    assert sorted(r["n"] for r in out.collect()) == list(range(1, 301))


@pytest.mark.parametrize("probs", [[0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]])
def test_quantiles_from_cells(ticks, small_ranges, probs):
    got = exact_quantiles(ticks, ["x", "y"], probs)
    want = ticks.toPandas()
    for c in ("x", "y"):
        assert got[c] == pytest.approx(want[c].quantile(probs).tolist())


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}
