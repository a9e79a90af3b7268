"""Round trips through every file format."""

import datetime as dt
import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tickspark import schemas
from tickspark.sources import readers, sinks


def put_zip(path, text, name="data.csv"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name, text)


@pytest.fixture
def public(tmp_path):
    base = tmp_path / "data"
    day = base / "spot/trades/BTCUSDT"
    put_zip(day / "BTCUSDT-trades-2024-12-31.zip", "1,100.5,2,201,1735603200123,True,True\n2,101,oops,0,1735603201000,False,True\n")
    put_zip(day / "BTCUSDT-trades-2025-01-01.zip", "3,102,1,102,1735689600123456,False,True\r\n")
    (day / "BTCUSDT-trades-2025-01-02.zip").write_bytes(b"not a zip")
    put_zip(day / "BTCUSDT-trades-2025-02.zip", "4,103,1,103,1738368000000000,True,True\n")
    put_zip(base / "spot/klines/BTCUSDT/1m/BTCUSDT-1m-2025-01-01.zip", "1735689600000000,10,12,9,11,5,1735689659999999,55,7,2,22,0\n")
    put_zip(base / "futures/um/aggTrades/ETHUSDT/ETHUSDT-aggTrades-2025-01-01.zip", "9,50,1,100,104,1735689600123,False,True\n")
    return str(base)


def test_public_trades(spark, public):
    out = readers.load_public(spark, public, "BTCUSDT").orderBy("trade_id").collect()
    assert [r["trade_id"] for r in out] == [1, 2, 3, 4]
    assert out[0]["ts"] == dt.datetime(2024, 12, 31, 0, 0, 0, 123000)
    assert out[2]["ts"] == dt.datetime(2025, 1, 1, 0, 0, 0, 123000)
    assert out[3]["ts"] == dt.datetime(2025, 2, 1)
    assert [r["side"] for r in out] == ["SELL", "BUY", "BUY", "SELL"]
    assert out[1]["qty"] is None and "oops" in out[1]["_corrupt_record"]
    assert out[0]["_corrupt_record"] is None
    assert {r["symbol"] for r in out} == {"BTCUSDT"}


def test_bad_archive_is_reported(spark, public):
    lines = readers.zip_lines(spark, f"{public}/spot/trades/BTCUSDT/*.zip")
    assert lines.where(F.col("error").isNotNull()).count() == 1


def test_date_range_of_files(spark, public):
    files = readers.list_public_files(spark, public, "BTCUSDT", start=dt.date(2025, 1, 1), end=dt.date(2025, 1, 31))
    assert sorted(str(r["file_date"]) for r in files.collect()) == ["2025-01-01", "2025-01-02"]
    with pytest.raises(ValueError):
        readers.list_public_files(spark, public, kind="klines")
    with pytest.raises(ValueError):
        readers.list_public_files(spark, public, market="moon")


def test_klines_and_agg_trades(spark, public):
    k = readers.load_public(spark, public, "BTCUSDT", "klines", interval="1m").first()
    assert k["ts"] == dt.datetime(2025, 1, 1)
    assert (k["range"], k["typical_price"]) == (3.0, pytest.approx(32 / 3))
    assert k["taker_buy_ratio"] == pytest.approx(0.4)
    assert "ignore" not in k.asDict()
    a = readers.load_public(spark, public, "ETHUSDT", "aggTrades", "um").first()
    assert (a["num_trades"], a["symbol"]) == (5, "ETHUSDT")
    assert a["ts"] == dt.datetime(2025, 1, 1, 0, 0, 0, 123000)


def test_schema_registry():
    assert "base_qty" in schemas.public_schema("cm", "trades").fieldNames()
    assert "is_best_match" not in schemas.public_schema("um", "trades").fieldNames()
    assert len(schemas.public_schema("spot", "klines")) == 12
    with pytest.raises(ValueError):
        schemas.public_schema("spot", "options")


def test_snapshots(spark, tmp_path):
    (tmp_path / "AAA.store").write_text("# note\n1,1704067200000,100,2,102,3,7\n1,1704067201000,0,0,0,0,1\n")
    (tmp_path / "BBB.store").write_text("1,1704067200000,10,1,11,1,5\n")
    (tmp_path / "skip.txt").write_text("1,2,3\n")
    out = readers.read_snapshots(spark, str(tmp_path)).orderBy("symbol", "timestamp").collect()
    assert [r["symbol"] for r in out] == ["AAA", "AAA", "BBB"]
    assert (out[0]["mid_price"], out[0]["spread"], out[0]["book_imbalance"]) == (101.0, 2.0, -0.2)
    assert out[1]["spread_bps"] is None and out[1]["book_imbalance"] is None
    assert readers.read_snapshots(spark, str(tmp_path), symbols=["BBB"]).count() == 1


def test_book_with_skipped_line(spark, tmp_path):
    path = tmp_path / "x.store"
    path.write_text("some header\n1,1704067200000,100,2,102,3,7\n1,1704067201000,100,2,102,3,\n")
    out = readers.read_book(spark, str(path), skip_rows=1).collect()
    assert len(out) == 1 and out[0]["bid_px"] == 100.0


def test_streamer_lines(spark, tmp_path):
    path = tmp_path / "s.store"
    path.write_text("AAA,1704067200000,1,2,3,4\nAAA,x,1,2,3,4,5\n\nAAA,1704067201000,1,2,3,4,9\nAAA,1,2\n")
    out = readers.read_streamer_snapshots(spark, str(path)).orderBy("timestamp").collect()
    assert [r["volume"] for r in out] == [0.0, 9.0]


def test_messages(spark, tmp_path):
    one = {"T": 1, "s": "AAA", "p": "1.5", "q": "2", "m": True, "t": 77}
    with gzip.open(tmp_path / "a.json.gz", "wt") as f:
        json.dump([one, {**one, "T": 2}], f)
    (tmp_path / "b.json").write_text(json.dumps({**one, "T": 3}))
    out = readers.read_messages(spark, str(tmp_path)).orderBy("T").collect()
    assert [r["T"] for r in out] == [1, 2, 3]


def test_log_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "timestamp,symbol,strategy_id,filled_qty,remaining_qty,open_qty,new_open_qty\n"
        "2024-01-01 00:00:00.5,X,1,NaN,null,2,3\nlater,X,1,1,1,1,1\n"
    )
    rows = readers.read_strategy_updates(spark, str(tmp_path / "a.csv")).collect()
    assert len(rows) == 1
    assert (rows[0]["filled_qty"], rows[0]["remaining_qty"], rows[0]["open_qty"]) == (None, None, 2.0)
    (tmp_path / "f").mkdir()
    (tmp_path / "f/1.csv").write_text("symbol,timestamp,price,qty,side,order_id\nX,2024-01-01 00:00:00.000,5,1,BUY,o1\nY,2024-01-01 00:00:01.000,6,1,SELL,o2\n")
    assert readers.read_fills(spark, str(tmp_path / "f"), ["Y"]).first()["price"] == 6.0


def test_log_files_with_different_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_text("timestamp,symbol,price,qty,side\n2024-01-01 00:00:00.000,X,5,1,BUY\n")
    (tmp_path / "2.csv").write_text(
        "\ufeffqty,extra,price,timestamp,symbol\n\n"
        '2,"a,b",6,2024-01-01 00:00:01.000,Y\n3,c,7,2024-01-01 00:00:02.000,"Y"\n'
    )
    (tmp_path / "3.csv").write_text("symbol,price\n")
    (tmp_path / "4.csv").write_text("")
    for path in (str(tmp_path), [str(f) for f in sorted(tmp_path.iterdir())]):
        out = readers.read_fills(spark, path).orderBy("timestamp").collect()
        assert [(r["symbol"], r["price"], r["qty"], r["side"]) for r in out] == [
            ("X", 5.0, 1.0, "BUY"), ("Y", 6.0, 2.0, None), ("Y", 7.0, 3.0, None),
        ]


def test_numeric_table(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("ts_ms,a\n0,1.5\n1000,2\n")
    bad.write_text("ts_ms,a\n0,word\n")
    out = readers.read_table(spark, str(good)).orderBy("ts_ms").collect()
    assert out[1]["a"] == 2.0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_table(spark, str(bad)).collect()
    with pytest.raises(ValueError):
        readers.read_table(spark, str(tmp_path / "x.txt"))


def test_feature_layouts(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, 5), "X", float(d)) for d in (1, 2, 9)], "timestamp_dt timestamp_ntz, symbol string, v double")
    sinks.write_features(df, str(tmp_path / "hive"))
    out = readers.read_feature_table(spark, str(tmp_path / "hive"), ["X"], dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert sorted(r["v"] for r in out.collect()) == [1.0, 2.0]
    for d in (1, 2, 9):
        df.where(F.col("v") == d).drop("symbol").coalesce(1).write.parquet(str(tmp_path / f"plain/X/2024-01-0{d}/05"))
    (tmp_path / "plain/X/2024-01-01/05/bad.parquet").write_bytes(b"broken")
    schema = df.drop("symbol").schema
    got = readers.read_features(
        spark, str(tmp_path / "plain"), ["X"], dt.date(2024, 1, 1), dt.date(2024, 1, 2), schema=schema
    ).collect()
    assert sorted((str(r["date"]), r["hour"], r["symbol"]) for r in got) == [("2024-01-01", "05", "X"), ("2024-01-02", "05", "X")]
    recent = readers.read_features(spark, str(tmp_path / "plain"), ["X"], days_back=3, today=dt.date(2024, 1, 10))
    assert [r["v"] for r in recent.collect()] == [9.0]


def test_local_features(spark, tmp_path):
    df = spark.createDataFrame([(1.0,)], "v double")
    df.toPandas().to_parquet(tmp_path / "one_X_full.parquet")
    (tmp_path / "deep").mkdir()
    df.toPandas().to_parquet(tmp_path / "deep/X.parquet")
    assert readers.read_local_features(spark, str(tmp_path), ["X"]).count() == 2


def test_split_dataset(spark, tmp_path):
    df = spark.createDataFrame([("X", 1, 2.0, 1, "train"), ("X", 2, 3.0, -1, "val")], "symbol string, ts int, f double, y_dir_5 int, split string")
    meta = sinks.write_splits(df, str(tmp_path / "d"), extra={"interval": "1s"})
    assert (meta["n_train"], meta["n_val"], meta["n_test"]) == (1, 1, 0)
    assert meta["feature_columns"] == ["f"] and meta["label_columns"] == ["y_dir_5"]
    assert sinks.read_json(spark, str(tmp_path / "d/metadata")) == meta
    assert readers.read_split(spark, str(tmp_path / "d/data"), "val").first()["f"] == 3.0


def test_csv_and_symbol_sinks(spark, tmp_path):
    df = spark.createDataFrame([("X", 1.0), ("Y", 2.0)], "symbol string, v double")
    sinks.to_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    sinks.write_by_symbol(df, str(tmp_path / "s"))
    assert (tmp_path / "s/symbol=X").is_dir()


def test_feature_key():
    assert sinks.feature_key("trades/X/2024-01-01/12/a.json.gz") == "features/X/2024-01-01/12/a.parquet"
    assert sinks.feature_key("trades/X/2024-01-01/12/a.store") == "features/X/2024-01-01/12/a.parquet"
