"""As-of semantics, grids, book features, segments and reports."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickspark.functions.expr import book_calendar, book_features, fill_zero, normalise_ticks
from tickspark.operators import align, metrics, quality, windows

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame([("X", at(s), i) for i, s in enumerate((0, 5, 9, 20))] + [("Y", at(5), 9)], "symbol string, ts timestamp_ntz, id int")
    rows = [("X", at(5), 1.0, "a"), ("X", at(8), None, "b"), ("X", at(12), 3.0, "c")]
    return left, spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, v double, name string")


def joined(sides, **kw):
    out = align.asof_join(*sides, **kw).collect()
    return {r["id"]: (r["v"], r["name"]) for r in out}


def test_backward_takes_equal_times_and_whole_rows(sides):
    got = joined(sides)
    # The row at 8 s holds a NULL, which is taken rather than an older value.
    assert got == {0: (None, None), 1: (1.0, "a"), 2: (None, "b"), 3: (3.0, "c"), 9: (None, None)}


def test_forward_and_nearest(sides):
    assert joined(sides, direction="forward") == {0: (1.0, "a"), 1: (1.0, "a"), 2: (3.0, "c"), 3: (None, None), 9: (None, None)}
    assert joined(sides, direction="nearest") == {0: (1.0, "a"), 1: (1.0, "a"), 2: (None, "b"), 3: (3.0, "c"), 9: (None, None)}


def test_no_direction_reads_to_the_end_for_every_row(sides):
    left, right = sides
    made = [align.asof_join(left, right, direction=d) for d in ("backward", "forward", "nearest", "exact")]
    made.append(align.fill_within(left, right, 60))
    for out in made:
        assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower()


def test_exact_and_tolerance(sides):
    assert joined(sides, direction="exact")[1] == (1.0, "a")
    assert joined(sides, direction="exact")[2] == (None, None)
    assert joined(sides, tolerance="7s")[3] == (None, None)
    assert joined(sides, tolerance="8s")[3] == (3.0, "c")
    with pytest.raises(ValueError):
        joined(sides, direction="sideways")


def test_asof_without_series(sides):
    left, right = sides
    out = align.asof_join(left, right.drop("symbol"), by=[]).where("id = 9").first()
    assert out["name"] == "a"


def test_asof_cut_into_ranges(spark, small_ranges):
    left = spark.range(400).select(F.lit("X").alias("symbol"), (F.col("id") % 50).alias("n"), F.timestamp_seconds(F.col("id") % 50).cast("timestamp_ntz").alias("ts"), "id")
    right = spark.range(0, 50, 7).select(F.lit("X").alias("symbol"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), F.col("id").alias("v"))
    out = align.asof_join(left, right).collect()
    assert len(out) == 400
    assert all(r["v"] == r["n"] // 7 * 7 for r in out)


def test_counts_do_not_repeat_on_quiet_points(spark):
    grid = align.time_grid(spark, at(0), at(3), "1s", ["X"])
    src = spark.createDataFrame([("X", at(1), 5, 9.0)], "symbol string, ts timestamp_ntz, n_fills int, last double")
    out = align.asof_chain(grid, {"f": src}, counts=["n_fills"]).orderBy("ts").collect()
    assert [(r["n_fills"], r["last"]) for r in out] == [(None, None), (5, 9.0), (0, 9.0), (0, 9.0)]
    kept = align.asof_chain(grid, {"f": src}, counts=["n_fills"], carry_counts=True).orderBy("ts").collect()
    assert [r["n_fills"] for r in kept] == [None, 5, 5, 5]


def test_long_grid(spark):
    span = spark.createDataFrame([("X", at(0)), ("X", at(20_000)), ("Y", at(3))], "symbol string, ts timestamp_ntz")
    out = align.span_grid([span], "1s")
    sizes = {r["symbol"]: (r["n"], r["d"]) for r in out.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ts").alias("d")).collect()}
    assert sizes == {"X": (20_001, 20_001), "Y": (1, 1)}


def test_signal_followed_by_fill(spark):
    signals = spark.createDataFrame([("X", at(0), 1), ("X", at(100), 2), ("Y", at(0), 3)], "symbol string, ts timestamp_ntz, id int")
    fills = spark.createDataFrame([("X", at(60)), ("X", at(60))], "symbol string, ts timestamp_ntz")
    got = {r["id"]: r["had_fill"] for r in align.fill_within(signals, fills, 60).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    assert {r["id"]: r["had_fill"] for r in align.fill_within(signals, fills, 59.5).collect()}[1] == 0


@pytest.fixture(scope="module")
def book(spark):
    rows = [("X", at(s + (5 if s > 2 else 0)), 100.0 + s, 101.0 + s, 2.0, 3.0, 1.0) for s in range(6)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, bid_px double, ask_px double, bid_qty double, ask_qty double, vol_base double")


def test_book_columns(book):
    out = windows.segment_rolling(quality.add_segments(book, "1s").withColumns(book_features()), [2]).orderBy("ts").collect()
    assert out[0]["mid"] == 100.5
    assert out[0]["r1"] is None
    assert out[1]["r1"] == pytest.approx(math.log(101.5) - math.log(100.5))
    assert [r["segment_id"] for r in out] == [1, 1, 1, 2, 2, 2]
    assert out[3]["r1"] is None  # first of its segment
    assert out[3]["vol_sum_2"] == 1.0


def test_short_segments_and_policies(spark, book):
    parts = quality.add_segments(book.where("bid_px != 105"), "1s")
    kept = quality.drop_short_segments(parts, 3)
    assert kept.count() == 3
    dropped = quality.add_segments(book, "1s", "drop").orderBy("ts").collect()
    assert len(dropped) == 5 and [r["segment_id"] for r in dropped] == [1, 1, 1, 2, 2]
    filled = quality.add_segments(book, "1s", "reindex_fill").orderBy("ts").collect()
    assert len(filled) == 11 and {r["segment_id"] for r in filled} == {1}
    assert filled[5]["bid_px"] == 102.0
    with pytest.raises(ValueError):
        quality.add_segments(book, "1s", "guess")


def test_segments_of_cut_series(spark, small_ranges):
    rows = [("X", at(i + 10 * (i // 90))) for i in range(360)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz")
    out = quality.add_segments(df, "1s").groupBy("segment_id").count().orderBy("segment_id").collect()
    assert [(r["segment_id"], r["count"]) for r in out] == [(1, 90), (2, 90), (3, 90), (4, 90)]


def test_report_counts_each_row_once(spark, book):
    bad = book.withColumn("bid_px", F.when(F.col("bid_px") == 100, -1.0).when(F.col("bid_px") == 101, 500.0).otherwise(F.col("bid_px")))
    bad = bad.withColumn("bid_qty", F.when(F.col("bid_px") != 103, F.col("bid_qty")))
    r = quality.book_report(bad).first()
    assert (r["total_rows"], r["dropped_null"], r["dropped_nonpositive"], r["dropped_crossed"], r["kept_rows"]) == (6, 1, 1, 1, 3)


def test_duplicate_time_raises(spark):
    df = spark.createDataFrame([(1000, 1.0), (1000, 2.0)], "ts_ms bigint, a double")
    with pytest.raises(ValueError, match="duplicate"):
        quality.quality_report(df)
    with pytest.raises(ValueError, match="missing"):
        quality.quality_report(df.drop("ts_ms"))
    nan = spark.createDataFrame([(1, float("nan"))], "ts_ms bigint, a double")
    with pytest.raises(ValueError, match="NaN"):
        quality.quality_report(nan)
    inf = spark.createDataFrame([(1, float("inf"))], "ts_ms bigint, a double")
    with pytest.raises(ValueError, match="infinite"):
        quality.quality_report(inf)


def test_quality_numbers(spark):
    df = spark.createDataFrame([(i * 1000 + (500 if i == 3 else 0), 7.0) for i in range(4)], "ts_ms bigint, a double")
    r = quality.quality_report(df).first()
    assert (r["rows"], r["dt_min"], r["dt_max"], r["dt_median"]) == (4, 1000, 1500, 1000.0)
    assert r["pct_dt_expected"] == pytest.approx(200 / 3)
    assert r["constant_cols"] == ["a"] and r["near_constant_cols"] == ["a"]


def test_overlapping_splits_raise(spark):
    a, b, c = (spark.createDataFrame([(t,) for t in ts], "ts_ms bigint") for ts in ((1, 5), (4, 8), (9, 12)))
    with pytest.raises(ValueError, match="overlap"):
        quality.compare_splits(a, b, c)
    fine = quality.compare_splits(a, c.where("ts_ms = 9"), c.where("ts_ms = 12")).first()
    assert (fine["gap_train_to_val"], fine["gap_val_to_test"]) == (4, 3)
    with pytest.raises(ValueError, match="columns"):
        quality.compare_splits(a, b.withColumn("x", F.lit(1)), c)


def test_one_class_raises(spark):
    df = spark.createDataFrame([("train", 1), ("train", 1), ("val", 0), ("val", 1)], "split string, label int")
    with pytest.raises(ValueError, match="train"):
        quality.require_classes(df)


def test_weekday_conventions(spark):
    row = spark.createDataFrame([(dt.datetime(2024, 1, 1, 6),)], "ts timestamp_ntz").select(
        *[c.alias(n) for n, c in book_calendar("ts").items()]
    ).first()
    assert (row["hour"], row["dow"]) == (6, 0)
    assert row["hour_sin"] == pytest.approx(1.0)


def test_message_shapes(spark):
    live = spark.createDataFrame([(1704067200000, "100.5", "2", True), (1704067201000, "bad", "1", False)], "T bigint, p string, q string, m boolean")
    out = normalise_ticks(live).orderBy("timestamp").collect()
    assert (out[0]["price"], out[0]["qty"], out[0]["trade_direction"]) == (100.5, 2.0, -1)
    assert out[1]["price"] is None and out[1]["trade_direction"] == 1
    short = spark.createDataFrame([(1704067200000, "1.5")], "t bigint, p string")
    assert normalise_ticks(short).first()["qty"] == 1.0
    with pytest.raises(ValueError):
        normalise_ticks(spark.range(1))


def test_fill_zero_keeps_types(spark):
    df = spark.createDataFrame([(None, float("nan"), "x")], "a bigint, b double, c string")
    out = fill_zero(df)
    assert out.first() == (0, 0.0, "x")
    assert [f.dataType for f in out.schema] == [f.dataType for f in df.schema]


def test_auc_limits(spark):
    df = spark.createDataFrame([(i % 2, float(i % 2)) for i in range(10)], "y int, p double")
    assert metrics.auc(df, F.col("y") == 1, "p").first()["auc"] == 1.0
    assert metrics.auc(df.withColumn("p", F.lit(0.5)), F.col("y") == 1, "p").first()["auc"] == 0.5
    assert metrics.auc(df.where("y = 1"), F.col("y") == 1, "p").first()["auc"] is None
