"""Streams over files, run to the end, against their batch forms."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickspark.operators.bars import flow_bars
from tickspark.operators.windows import tick_features
from tickspark.sources.readers import read_messages
from tickspark.streaming import streams

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "symbol string, ts timestamp, trade_id bigint, price double, qty double, is_buyer_maker boolean"


def rows_for(start, n, symbol="X"):
    return [(symbol, T0 + dt.timedelta(seconds=i), i, 100 + (i * 7 % 13) * 0.5, 1.0 + i % 3, i % 2 == 0) for i in range(start, start + n)]


@pytest.fixture
def feed(spark, tmp_path):
    """Files of trades arriving one after the other."""
    src = tmp_path / "in"

    def put(rows, name):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(src / name))

    def stream():
        reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
        return reader.parquet(str(src))

    src.mkdir()
    return put, stream


def collect(stream, tmp_path, name="out"):
    """Rows a stream emits until nothing is left."""
    got = []
    streams.run_available(stream, lambda df, _: got.extend(df.collect()), str(tmp_path / f"ck-{name}"))
    return got


def features(spark, stream, tmp_path, **options):
    """Tick features of a stream run until nothing is left."""
    out, state = str(tmp_path / "features"), str(tmp_path / "state")
    streams.stream_tick_features(stream, out, state, str(tmp_path / "ck"), delay="1 minute", **options).awaitTermination()
    return spark.read.parquet(out).collect()


def test_bars_equal_batch_bars(spark, feed, tmp_path):
    put, stream = feed
    rows = rows_for(0, 40) + rows_for(0, 40, "Y")
    put(rows[:50], "a")
    put(rows[50:], "b")
    put(rows_for(1000, 1, "END"), "z")
    got = collect(streams.stream_flow_bars(stream(), "10s", delay="1 hour"), tmp_path)
    want = flow_bars(spark.createDataFrame(rows, SCHEMA), "10s").collect()
    # The last bars stay open until later data arrives.
    assert got == []
    put(rows_for(90_000, 1, "END"), "zz")
    put(rows_for(90_001, 1, "END"), "zzz")
    got = collect(streams.stream_flow_bars(stream(), "10s", delay="1 hour"), tmp_path)
    key = lambda r: (r["symbol"], r["ts"])
    got = sorted((r.asDict() for r in got if r["symbol"] != "END"), key=key)
    assert got == sorted((r.asDict() for r in want), key=key)


def test_copies_are_dropped(feed, tmp_path):
    put, stream = feed
    put(rows_for(0, 10), "a")
    put(rows_for(5, 10), "b")
    got = collect(streams.stream_dedup(stream()), tmp_path)
    assert sorted(r["trade_id"] for r in got) == list(range(15))


def test_segments(feed, tmp_path):
    put, stream = feed
    put(rows_for(0, 5) + rows_for(20, 3), "a")
    put(rows_for(5000, 1), "b")
    put(rows_for(9000, 1), "c")
    got = collect(streams.stream_segments(stream(), "2s"), tmp_path)
    assert sorted(r["n"] for r in got if r["start"] < T0 + dt.timedelta(seconds=100)) == [3, 5]


def test_tick_state_runs_on(spark, feed, tmp_path):
    """Features of ticks that come in several files, out of order within the delay."""
    put, stream = feed
    rows = rows_for(0, 60)
    put(rows[0:25] + rows[30:33], "a")
    put(rows[25:30] + rows[33:60], "b")
    put(rows_for(5000, 1), "c")
    put(rows_for(9000, 1), "d")

    def ticks(df):
        return df.withColumn("trade_direction", F.when(F.col("is_buyer_maker"), -1).otherwise(1))

    got = features(spark, ticks(stream()), tmp_path)
    got = sorted((r for r in got if r["at"] < 1_704_067_300_000_000), key=lambda r: r["at"])
    want = tick_features(ticks(spark.createDataFrame(rows, SCHEMA)), order=["ts"]).orderBy("ts").collect()
    assert len(got) == 60
    for g, w in zip(got, want):
        for c in ("return_1", "price_ma_10", "price_std_30", "volume_sum_5", "return_lag_5", "order_flow_30"):
            if w[c] is None:
                assert g[c] is None or g[c] != g[c]
            else:
                assert g[c] == pytest.approx(w[c], abs=1e-9)


def test_ticks_of_equal_time_follow_the_tie_column(spark, feed, tmp_path):
    put, stream = feed
    rows = [("X", T0, i, p, 1.0, True) for i, p in enumerate([10.0, 12.0, 0.0, 11.0, None, 9.0])]
    put(rows[::2], "a")
    put(rows[1::2], "b")
    put(rows_for(5000, 1), "c")
    put(rows_for(9000, 1), "d")
    side = F.lit(1)
    got = features(spark, stream().withColumn("trade_direction", side), tmp_path, tie="trade_id")
    got.sort(key=lambda r: (r["symbol"], r["at"], r["batch"]))
    got = [r for r in got if r["at"] == 1_704_067_200_000_000]
    batch = spark.createDataFrame(rows, SCHEMA).withColumn("trade_direction", side)
    want = tick_features(batch, order=["ts", "trade_id"]).orderBy("trade_id").collect()
    for c in ("price", "return_1", "return_lag_1", "price_lag_1", "price_std_5", "return_ma_5", "order_flow_10"):
        seen = [None if r[c] is None or r[c] != r[c] else r[c] for r in got]
        assert seen == [None if r[c] is None else pytest.approx(r[c]) for r in want], c


def message(i, price="10"):
    return {"T": 1_704_067_200_000 + i * 1000, "s": "AAA", "p": price, "q": "2", "m": i % 2 == 0}


def test_ingest_layout(spark, tmp_path):
    src = tmp_path / "raw"
    src.mkdir()
    (src / "1.json").write_text(json.dumps([message(i) for i in range(5)]))
    q = streams.ingest(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck"), every=None)
    q.awaitTermination()
    files = list((tmp_path / "out").rglob("*.json.gz"))
    assert files and "symbol=AAA/date=2024-01-01/hour=00" in str(files[0])
    assert spark.read.json(str(tmp_path / "out")).count() == 5


def test_features_on_arrival(spark, tmp_path):
    src = tmp_path / "trades"
    src.mkdir()
    (src / "good.json").write_text(json.dumps([message(i) for i in range(8)]))
    (src / "one.json").write_text(json.dumps(message(99)))
    (src / "empty.json").write_text("[]")
    (src / "broken.json").write_text("{oops")
    (src / "book.store").write_text("BBB,1704067200000,10,1,12,1\nBBB,1704067201000,11,1,13,1\n")
    out, res = str(tmp_path / "features"), str(tmp_path / "results")
    streams.process_arrivals(spark, str(src), out, res, str(tmp_path / "ck")).awaitTermination()
    status = {r["source"].rsplit("/", 1)[1]: (r["status"], r["record_count"]) for r in spark.read.parquet(res).collect()}
    assert status == {
        "good.json": ("success", 8),
        "one.json": ("success", 1),
        "empty.json": ("skipped", 0),
        "broken.json": ("error", 0),
        "book.store": ("success", 2),
    }
    made = spark.read.parquet(out)
    assert made.count() == 11
    book = made.where("symbol = 'BBB'").orderBy("timestamp").collect()
    assert [r["price"] for r in book] == [11.0, 12.0]
    assert book[1]["return_1"] == pytest.approx(1 / 11)
    # The single message is alone in its file, so it has no earlier price.
    assert made.where("timestamp = 1704067299000").first()["return_1"] is None
    # Nothing new: nothing is written twice.
    streams.process_arrivals(spark, str(src), out, res, str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(out).count() == 11


def test_arrivals_of_equal_time_keep_their_order(spark, tmp_path):
    src = tmp_path / "trades"
    src.mkdir()
    (src / "a.json").write_text(json.dumps([message(0, p) for p in ("10", "12", "9", "11")]))
    out = str(tmp_path / "features")
    streams.process_arrivals(spark, str(src), out, str(tmp_path / "r"), str(tmp_path / "ck")).awaitTermination()
    made = spark.read.parquet(out)
    assert "position" not in made.columns
    steps = {r["price"]: r["return_1"] for r in made.collect()}
    assert steps[10.0] is None
    assert [steps[p] for p in (12.0, 9.0, 11.0)] == pytest.approx([2 / 10, -3 / 12, 2 / 9])


def test_mixed_files_and_their_quarantine(spark, tmp_path):
    src = tmp_path / "trades"
    src.mkdir()
    rows = [message(0), {"s": "AAA", "p": "1"}, message(1, "x"), 17, message(2), {**message(3), "q": "?"}, {**message(4), "T": "soon"}]
    (src / "mixed.json").write_text(json.dumps(rows))
    (src / "bad.json").write_text("{oops")
    (src / "book.store").write_text("BBB,1704067200000,10,1,12,1\nBBB,soon,10,1,12,1\n\nBBB,1\nBBB,1704067200000,,1,12,1\n")
    out, res, bad = (str(tmp_path / n) for n in ("features", "results", "bad"))
    for _ in range(2):  # a second run finds nothing new
        streams.process_arrivals(spark, str(src), out, res, str(tmp_path / "ck"), quarantine=bad).awaitTermination()
        got = {
            (r["source"].rsplit("/", 1)[1], r["position"]): (r["rule"], r["raw"]) for r in spark.read.parquet(bad).collect()
        }
        assert {k: v[0] for k, v in got.items()} == {
            ("mixed.json", 1): "no time", ("mixed.json", 2): "no price", ("mixed.json", 3): "malformed row",
            ("mixed.json", 5): "no quantity", ("mixed.json", 6): "no time", ("bad.json", None): "malformed file",
            ("book.store", 1): "no time", ("book.store", 3): "malformed row", ("book.store", 4): "no price",
        }
        assert got["mixed.json", 3][1] == "17" and got["bad.json", None][1] == "{oops"
        assert got["book.store", 3][1] == "BBB,1"
        results = {
            r["source"].rsplit("/", 1)[1]: (r["record_count"], r["rejected_count"], r["status"], r["reason"])
            for r in spark.read.parquet(res).collect()
        }
        assert results == {
            "mixed.json": (2, 5, "success", "no time"), "bad.json": (0, 1, "error", "malformed file"),
            "book.store": (1, 3, "success", "no time"),
        }
        made = spark.read.parquet(out)
        assert made.count() == 3
        keys = {r[0].rsplit("trades", 1)[-1].rsplit("features", 1)[-1] for r in made.select("output_key").distinct().collect()}
        assert keys == {"/mixed.parquet", "/book.parquet"}


def batches(spark, path):
    made = spark.read.json(str(path)).groupBy("symbol", "batch").count().orderBy("symbol", "batch")
    return [tuple(r) for r in made.collect()]


def test_batches_of_a_thousand(spark, tmp_path):
    src = tmp_path / "raw"
    src.mkdir()
    (src / "1.json").write_text(json.dumps([message(i) for i in range(1300)]))
    (src / "2.json").write_text(json.dumps([message(i) for i in range(1300, 2500)] + [{**message(1), "s": "BBB"}]))
    streams.ingest(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck"), every=None).awaitTermination()
    assert batches(spark, tmp_path / "out") == [("AAA", 0, 1000), ("AAA", 1, 1000), ("AAA", 2, 500), ("BBB", 0, 1)]
    assert spark.read.json(str(tmp_path / "out")).select("T").distinct().count() == 2500


def test_waiting_messages_are_flushed_by_time(spark, tmp_path):
    import time

    src = tmp_path / "raw"
    src.mkdir()
    (src / "1.json").write_text(json.dumps([message(i) for i in range(25)]))
    q = streams.ingest(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck"), rows=10, seconds=1, every="1 second")
    try:
        until = time.monotonic() + 60
        while time.monotonic() < until and len(list((tmp_path / "out").rglob("*.json.gz"))) < 2:
            time.sleep(0.5)
    finally:
        q.stop()
    assert batches(spark, tmp_path / "out") == [("AAA", 0, 10), ("AAA", 1, 10), ("AAA", 2, 5)]


def test_all_late_rows_are_counted(spark, tmp_path):
    """Also those of batches that the query no longer remembers."""
    src = tmp_path / "in"
    src.mkdir()
    late = streams.LateRows.watch(spark)
    remembered = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(remembered, "2")
    try:
        for k in range(7):
            rows = rows_for(100_000 if k == 0 else 200_000 if k == 1 else k, 1, "S")
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(src / f"{k}"))
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(src))
        q = streams.run_available(streams.stream_flow_bars(stream, "1s"), lambda df, _: df.collect(), str(tmp_path / "ck"))
        assert len(q.recentProgress) < 7
        assert late.total(q) == 5
    finally:
        spark.conf.unset(remembered)
        spark.streams.removeListener(late)


def test_hot_symbol_is_held_by_slices(spark, feed, tmp_path):
    """State is per symbol and slice; a repeated run adds nothing."""
    put, stream = feed
    rows = rows_for(0, 300) + rows_for(0, 20, "Y")
    put(rows[:200], "a")
    put(rows[200:], "b")
    put(rows_for(5000, 1), "c")
    put(rows_for(9000, 1), "d")
    side = F.lit(1)
    got = features(spark, stream().withColumn("trade_direction", side), tmp_path, slice_="1m")
    got = {(r["symbol"], r["at"]): r["price_ma_30"] for r in got if r["at"] < 1_704_067_600_000_000}
    want = tick_features(spark.createDataFrame(rows, SCHEMA).withColumn("trade_direction", side), order=["ts"])
    want = {(r["symbol"], r["us"]): r["price_ma_30"] for r in want.withColumn("us", F.unix_micros("ts")).collect()}
    assert got.keys() == want.keys() and len(got) == 320
    assert all(got[k] == pytest.approx(want[k]) for k in got)
    again = features(spark, stream().withColumn("trade_direction", side), tmp_path, slice_="1m")
    assert len([r for r in again if r["at"] < 1_704_067_600_000_000]) == 320


def test_state_store_is_asked_for(spark, tmp_path):
    from tickspark.streaming import state

    before = spark.conf.get(state.PROVIDER)
    spark.conf.unset(state.PROVIDER)
    try:
        with pytest.raises(ValueError, match="stateStore"):
            state.require_state_store(spark)
    finally:
        spark.conf.set(state.PROVIDER, before)


def test_messages_read_back(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps([message(1)]))
    assert read_messages(spark, str(tmp_path)).first()["p"] == "10"
