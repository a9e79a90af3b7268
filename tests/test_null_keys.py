"""NULL series keys and infinities in operators that group and join."""

import math

import pytest

from tickspark.operators.quality import drop_short_segments
from tickspark.operators.quantiles import exact_quantiles
from tickspark.operators.windows import cumulative_return
from tickspark.sources.readers import file_ledger, read_book


def test_null_symbols_stay(spark):
    rows = [(None, 1, 2.0, 0), (None, 2, 3.0, 0), ("a", 1, 4.0, 0)]
    df = spark.createDataFrame(rows, "symbol string, ts long, close double, segment_id long")
    assert drop_short_segments(df, 1).count() == 3
    assert [r.symbol for r in drop_short_segments(df, 2).collect()] == [None, None]
    got = {(r.symbol, r.ts): r.cum_return for r in cumulative_return(df).collect()}
    assert got == {(None, 1): 0.0, (None, 2): 0.5, ("a", 1): 0.0}


def test_quantiles_with_infinities_when_cut(spark, small_ranges):
    values = [float(i) for i in range(100)] + [math.inf] * 100
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_quantiles(df, ["v"], [0.0, 0.75, 1.0])["v"] == [0.0, math.inf, math.inf]


@pytest.mark.parametrize(("skip", "header"), [(2, False), (1, True), (3, False), (9, False)])
def test_leading_lines_of_every_file(spark, tmp_path, skip, header):
    """Numeric lines too, and in each file of a folder."""
    for name in "ab":
        lines = [f"1,{t},1,1,2,1,1" if name == "a" else f"1,{t},3,1,4,1,1" for t in range(5)]
        (tmp_path / f"{name}.store").write_text("\n".join(lines) + "\n")
    got = read_book(spark, str(tmp_path), skip_rows=skip, header=header).collect()
    gone = skip + header
    assert sorted((r.bid_px, r.ts_ms) for r in got) == [(b, t) for b in (1.0, 3.0) for t in range(gone, 5)]


def test_ledger_of_files(spark, tmp_path):
    for name, n in (("good", 100), ("empty", 0), ("torn", 3000)):
        df = spark.range(n).selectExpr("id", "rand(1) AS x", "repeat(uuid(), 20) AS y")
        df.coalesce(1).write.option("parquet.block.size", 65536).parquet(str(tmp_path / name))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "bad.parquet").write_bytes(b"nothing like it")
    torn = next((tmp_path / "torn").glob("*.parquet"))
    body = bytearray(torn.read_bytes())
    body[len(body) // 2 : len(body) // 2 + 4000] = bytes(4000)
    torn.write_bytes(bytes(body))
    for crc in tmp_path.rglob("*.crc"):
        crc.unlink()
    got = {r["file"].split("/")[-2]: r for r in file_ledger(spark, str(tmp_path)).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"good": "read", "empty": "read", "bad": "unread", "torn": "cut short"}
    assert got["good"]["rows"] == got["good"]["rows_read"] == 100 and got["empty"]["rows"] == 0
    assert got["bad"]["error"] and got["bad"]["bytes"] == 15 and got["good"]["error"] is None
    assert got["torn"]["rows"] == 3000 > got["torn"]["rows_read"]
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "x.parquet").write_bytes(b"none")
    assert [r["status"] for r in file_ledger(spark, str(tmp_path / "only")).collect()] == ["unread"]
