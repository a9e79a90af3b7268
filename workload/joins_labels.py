"""Grids, as-of alignment, joins and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickspark.functions.expr import prefixed
from tickspark.operators import align, bars, labels, windows
from workload.bars_windows import (
    BOOK_KEY,
    DONE_D,
    EVENT,
    SEG,
    STRAT_D,
    fill_bars,
    flow,
    rounded,
    segmented,
    signal_bars,
    ticks,
)
from workload.registry import SHARED, query
from workload.views import Views

# -- grids ---------------------------------------------------------------------------


@query("""WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM trades)
 SELECT s.symbol, g.ts FROM (SELECT DISTINCT symbol FROM trades) s,
 (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM b) g""")
def grid_cross(v: Views):
    lo, hi = bars.ohlcv_bars(v.trades, "1h", by=[], order=EVENT).agg(F.min("ts"), F.max("ts")).first()
    symbols = [r[0] for r in v.trades.select("symbol").distinct().collect()]
    return align.time_grid(v.spark, lo, hi, "1h", symbols)


SHARED["spans"] = """SELECT symbol, min(ts) AS lo, max(ts) AS hi FROM (SELECT symbol, ts FROM strat UNION ALL
 SELECT symbol, ts FROM done) GROUP BY symbol"""
SHARED["grid"] = "SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM spans"


def log_buckets(v: Views):
    return bars.strategy_buckets(v.updates, "1h"), bars.fill_buckets(v.log_fills, "1h", order=("ts", "fill_id"))


@query("SELECT symbol, ts FROM grid")
def grid_symbol(v: Views):
    return align.span_grid(log_buckets(v), "1h")


# -- as-of ---------------------------------------------------------------------------


def _right(v: Views):
    return v.fills.select("symbol", "ts", "fill_id", "side", F.col("qty").alias("fill_qty"))


@query("""SELECT s.symbol, s.ts, s.signal_id, f.fill_id, f.side, R(f.qty) AS fill_qty, f.ts AS fill_ts
 FROM signals s ASOF LEFT JOIN fills f ON s.symbol = f.symbol AND s.ts >= f.ts""")
def asof_backward(v: Views):
    left = v.signals.select("symbol", "ts", "signal_id")
    return align.asof_join(left, _right(v), tiebreak=["fill_id"], matched="fill_ts")


@query("""SELECT s.symbol, s.ts, s.signal_id, f.fill_id, f.side, R(f.qty) AS fill_qty, f.ts AS fill_ts
 FROM signals s ASOF LEFT JOIN fills f ON s.symbol = f.symbol AND s.ts <= f.ts""")
def asof_forward(v: Views):
    left = v.signals.select("symbol", "ts", "signal_id")
    return align.asof_join(left, _right(v), direction="forward", tiebreak=["fill_id"], matched="fill_ts")


@query("""WITH b AS (SELECT s.symbol, s.ts, s.signal_id, f.fill_id AS bid, f.ts AS bts FROM signals s ASOF LEFT JOIN fills f
 ON s.symbol = f.symbol AND s.ts >= f.ts), a AS (SELECT b.*, f.fill_id AS aid, f.ts AS ats FROM b ASOF LEFT JOIN fills f
 ON b.symbol = f.symbol AND b.ts <= f.ts), n AS (SELECT *, CASE WHEN ats IS NOT NULL AND (bts IS NULL OR
 epoch_us(ats) - epoch_us(ts) < epoch_us(ts) - epoch_us(bts)) THEN aid ELSE bid END AS hit, CASE WHEN ats IS NOT NULL AND
 (bts IS NULL OR epoch_us(ats) - epoch_us(ts) < epoch_us(ts) - epoch_us(bts)) THEN ats ELSE bts END AS hit_ts FROM a)
 SELECT symbol, ts, signal_id, CASE WHEN abs(epoch_us(hit_ts) - epoch_us(ts)) <= 600000000 THEN hit END AS fill_id FROM n""")
def asof_nearest(v: Views):
    left = v.signals.select("symbol", "ts", "signal_id")
    right = v.fills.select("symbol", "ts", "fill_id")
    return align.asof_join(left, right, direction="nearest", tolerance="10m", tiebreak=["fill_id"])


SHARED["minutes"] = """SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS timestamp FROM (SELECT symbol,
 max(lo) AS lo, min(hi) AS hi FROM (SELECT symbol, min(timestamp) AS lo, max(timestamp) AS hi FROM sigbars GROUP BY symbol
 UNION ALL SELECT symbol, min(timestamp), max(timestamp) FROM fillbars GROUP BY symbol) GROUP BY symbol HAVING count(*) = 2)"""


@query("""SELECT g.symbol, g.timestamp, s.last_signal, R(s.avg_signal) AS avg_signal,
 CASE WHEN s.timestamp = g.timestamp THEN s.n_signals WHEN s.timestamp IS NOT NULL THEN 0 END AS n_signals,
 R(f.last_fill_price) AS last_fill_price,
 CASE WHEN f.timestamp = g.timestamp THEN f.n_fills WHEN f.timestamp IS NOT NULL THEN 0 END AS n_fills
 FROM minutes g ASOF LEFT JOIN sigbars s ON g.symbol = s.symbol AND g.timestamp >= s.timestamp
 ASOF LEFT JOIN fillbars f ON g.symbol = f.symbol AND g.timestamp >= f.timestamp""")
def asof_chain(v: Views):
    signals = signal_bars(v).select("symbol", "timestamp", "last_signal", "avg_signal", "n_signals")
    fills = fill_bars(v).select("symbol", "timestamp", "last_fill_price", "n_fills")
    grid = align.span_grid([signals, fills], "1m", ts="timestamp", common=True)
    sources = {"signals": signals, "fills": fills}
    return align.asof_chain(grid, sources, on="timestamp", counts=["n_signals", "n_fills"])


@query("""WITH n AS (SELECT s.*, f.ts AS fill_ts FROM signals s ASOF LEFT JOIN fills f ON s.symbol = f.symbol AND s.ts <= f.ts)
 SELECT symbol, ts, signal_id, CASE WHEN epoch_us(fill_ts) - epoch_us(ts) <= 3600000000 THEN 1 ELSE 0 END AS had_fill,
 CASE WHEN epoch_us(fill_ts) - epoch_us(ts) <= 3600000000 THEN R((epoch_us(fill_ts) - epoch_us(ts)) / 1e6::DOUBLE) END
 AS fill_delay_s FROM n""")
def signal_fill_interval(v: Views):
    out = align.fill_within(v.signals, v.fills, 3600)
    return out.select("symbol", "ts", "signal_id", "had_fill", "fill_delay_s")


# -- joins ------------------------------------------------------------------------------


SHARED["matrix"] = """SELECT g.symbol, g.ts, n_strat_events, sum_filled_qty, sum_remaining_qty, sum_open_qty, sum_new_open_qty,
 n_strategies, fill_ratio, delta_open, n_fills, sum_fill_qty, mean_fill_price, last_fill_price, buy_qty, sell_qty,
 net_fill_qty, fill_imbalance FROM grid g LEFT JOIN strat s ON g.symbol = s.symbol AND g.ts = s.ts
 LEFT JOIN done f ON g.symbol = f.symbol AND g.ts = f.ts"""


@query(f"SELECT symbol, ts, n_strat_events, n_strategies, n_fills, {rounded(*STRAT_D, *DONE_D)} FROM matrix")
def matrix_left(v: Views):
    strat, done = log_buckets(v)
    return align.left_matrix(align.span_grid([strat, done], "1h"), strat, done)


@query("""SELECT t.symbol, t.ts, R(t.close) AS close, R(t.volume) AS volume, R(a.close) AS close_view, R(a.volume) AS volume_view,
 R(b.close) AS close_purchase, R(b.volume) AS volume_purchase FROM (SELECT * FROM flow WHERE symbol = 'click') t
 LEFT JOIN (SELECT * FROM flow WHERE symbol = 'view') a ON t.ts = a.ts
 LEFT JOIN (SELECT * FROM flow WHERE symbol = 'purchase') b ON t.ts = b.ts""")
def cross_asset(v: Views):
    rows = flow(v).select("symbol", "ts", "close", "volume")
    return align.cross_asset(rows, "click", ["view", "purchase"])


@query("""SELECT symbol, ts, signal_id, NULL::BIGINT AS fill_id, R(mid_price) AS price FROM signals
 UNION ALL SELECT symbol, ts, NULL, fill_id, R(price) FROM fills""")
def union_by_name(v: Views):
    left = v.signals.select("symbol", "ts", "signal_id", F.col("mid_price").alias("price"))
    return align.union_all([left, v.fills.select("fill_id", "price", "symbol", "ts")])


@query("""SELECT coalesce(s.symbol, f.symbol) AS symbol, coalesce(n_signals, 0) AS n_signals, coalesce(n_fills, 0) AS n_fills
 FROM (SELECT symbol, count(*) AS n_signals FROM signals GROUP BY symbol) s
 FULL JOIN (SELECT symbol, count(*) AS n_fills FROM fills GROUP BY symbol) f ON s.symbol = f.symbol""")
def symbol_stats(v: Views):
    return align.symbol_stats(v.signals, v.fills)


@query("""SELECT 'signals' AS source, min(ts) AS start, max(ts) AS "end" FROM signals
 UNION ALL SELECT 'fills', min(ts), max(ts) FROM fills""")
def time_ranges(v: Views):
    return align.time_ranges({"signals": v.signals, "fills": v.fills})


@query("""SELECT greatest(s.a, f.a) AS start, least(s.b, f.b) AS "end" FROM (SELECT min(ts) AS a, max(ts) AS b FROM signals) s,
 (SELECT min(ts) AS a, max(ts) AS b FROM fills) f""")
def overlap(v: Views):
    return align.overlap({"signals": v.signals, "fills": v.fills})


@query("SELECT symbol FROM signals UNION SELECT symbol FROM fills UNION SELECT symbol FROM trades")
def available_symbols(v: Views):
    return align.available_symbols([v.signals, v.fills, v.trades])


@query("SELECT symbol, ts, R(close) AS public_close FROM flow")
def prefixed_columns(v: Views):
    return prefixed(flow(v).select("symbol", "ts", "close"), "public_")


# -- labels --------------------------------------------------------------------------------

O = "OVER (PARTITION BY symbol ORDER BY ts)"


def _lead_ln(h: int) -> str:
    r = f"lead(close, {h}) {O} / NULLIF(close, 0)"
    return f"CASE WHEN {r} > 0 THEN ln({r}) END"


SHARED["rets"] = f"SELECT *, {_lead_ln(5)} AS y_ret_5, {_lead_ln(30)} AS y_ret_30 FROM flow"


@query("SELECT symbol, ts, R(y_ret_5) AS y_ret_5, R(y_ret_30) AS y_ret_30 FROM rets")
def label_logret(v: Views):
    return labels.add_return_labels(flow(v), [5, 30]).select("symbol", "ts", "y_ret_5", "y_ret_30")


def three(x: str, z: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} > {z} THEN 1 WHEN {x} < -({z}) THEN -1 ELSE 0 END"


@query(f"SELECT symbol, ts, {three('y_ret_5', '0.1::DOUBLE')} AS y_dir_5, {three('y_ret_30', '0.1::DOUBLE')} AS y_dir_30 FROM rets")
def label_dir(v: Views):
    out = labels.add_direction_labels(labels.add_return_labels(flow(v), [5, 30]), [5, 30], deadzone_bps=1000)
    return out.select("symbol", "ts", "y_dir_5", "y_dir_30")


SHARED["segrets"] = f"SELECT *, lead(log_mid, 3) OVER ({SEG}) - log_mid AS y_ret_3 FROM diffs"


def _book_labels(v: Views, deadzone: str):
    rows = windows.segment_rolling(segmented(v), [5], order=BOOK_KEY)
    return labels.add_book_labels(rows, [3], deadzone, 1000, order=BOOK_KEY)


@query("SELECT symbol, ts, seq, R(y_ret_3) AS y_ret_3 FROM segrets")
def label_seg_ret(v: Views):
    return _book_labels(v, "half_spread").select("symbol", "ts", "seq", "y_ret_3")


@query(f"""SELECT symbol, ts, seq, {three('y_ret_3', 'CASE WHEN (mid + spread / 2) / NULLIF(mid, 0) > 0 THEN ln((mid + spread / 2) / mid) END')}
 AS y_dir_3 FROM segrets""")
def label_half_spread(v: Views):
    return _book_labels(v, "half_spread").select("symbol", "ts", "seq", "y_dir_3")


@query(f"SELECT symbol, ts, seq, {three('y_ret_3', '0.1::DOUBLE')} AS y_dir_3 FROM segrets")
def label_fixed_bps(v: Views):
    return _book_labels(v, "fixed_bps").select("symbol", "ts", "seq", "y_dir_3")


def _vol(r: str, h: int, w: str) -> str:
    return f"CASE WHEN count({r}) OVER {w} >= {h} THEN sqrt(sum({r} * {r}) OVER {w}) END"


@query(f"""SELECT symbol, ts, R({_vol('log_return', 5, 'w')}) AS y_vol_5 FROM flow
 WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)""")
def label_vol(v: Views):
    return labels.add_volatility_labels(flow(v), [5]).select("symbol", "ts", "y_vol_5")


@query(f"SELECT symbol, ts, seq, R({_vol('r1', 3, 'w')}) AS y_vol_3 FROM diffs WINDOW w AS ({SEG} ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)")
def label_seg_vol(v: Views):
    return _book_labels(v, "half_spread").select("symbol", "ts", "seq", "y_vol_3")


@query(f"""WITH m AS (SELECT symbol, ts, lead(last_fill_price, 5) {O} AS future_price, last_fill_price AS p FROM done)
 SELECT symbol, ts, R(future_price) AS future_price, R((future_price - p) / NULLIF(p, 0)) AS future_return,
 {three('((future_price - p) / NULLIF(p, 0))', '5e-4::DOUBLE')} AS price_move_cls FROM m""")
def label_move(v: Views):
    out = labels.price_move_labels(log_buckets(v)[1], 5)
    return out.select("symbol", "ts", "future_price", "future_return", "price_move_cls")


@query("""WITH m AS (SELECT symbol, ts, CASE WHEN count(sum_filled_qty) OVER w >= 5 THEN sum(sum_filled_qty) OVER w END AS s FROM strat
 WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING))
 SELECT symbol, ts, R(s) AS future_fill_sum, CAST(s > 0 AS INTEGER) AS will_fill FROM m""")
def label_will_fill(v: Views):
    out = labels.execution_labels(log_buckets(v)[0], 5)
    return out.select("symbol", "ts", "future_fill_sum", "will_fill")


@query("""SELECT symbol, timestamp, CAST(CASE WHEN count(n_fills) OVER w >= 3 THEN sum(n_fills) OVER w END > 0 AS INTEGER) AS label
 FROM fillbars WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)""")
def label_auto(v: Views):
    out = labels.create_labels(fill_bars(v), "auto", 3, order=["timestamp"])
    return out.select("symbol", "timestamp", "label")


@query("""SELECT symbol, timestamp, CAST(lead(close, 3) OVER (PARTITION BY symbol ORDER BY timestamp) > close AS INTEGER) AS label
 FROM bookbars""")
def label_price_direction(v: Views):
    rows = bars.book_bars(v.snapshots, "1h", order=("timestamp", "seq"))
    return labels.create_labels(rows, "price_direction", 3, order=["timestamp"]).select("symbol", "timestamp", "label")


_TO = "PARTITION BY symbol ORDER BY timestamp, trade_id"


@query(f"""WITH m AS (SELECT *, lead(price, 30) OVER ({_TO}) / NULLIF(price, 0) - 1 AS move FROM ticks)
 SELECT symbol, timestamp, trade_id, CAST(move > 1e-4::DOUBLE AS INTEGER) AS direction,
 CASE WHEN move IS NULL THEN NULL WHEN move > 1e-4::DOUBLE THEN 2 WHEN move < -(1e-4::DOUBLE) THEN 0 ELSE 1 END AS direction_3,
 R(move) AS regression, R(CASE WHEN count(return_1) OVER w >= 30 THEN stddev_samp(return_1) OVER w END) AS volatility
 FROM m WINDOW w AS ({_TO} ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING)""")
def label_train(v: Views):
    order = ["timestamp", "trade_id"]
    out = windows.tick_features(ticks(v), order=order, plain=True).select("symbol", *order, "price", "return_1")
    for kind in ("direction", "direction_3", "regression", "volatility"):
        out = labels.training_labels(out, kind, order=order).withColumnRenamed("label", kind)
    return out.drop("price", "return_1")


@query(f"SELECT symbol, timestamp, trade_id, CAST(lead(return_1) OVER ({_TO}) > 0 AS INTEGER) AS target FROM ticks")
def label_next(v: Views):
    order = ["timestamp", "trade_id"]
    out = windows.tick_features(ticks(v), order=order, plain=True)
    return labels.next_up_label(out, order=order).select("symbol", *order, "target")


@query(f"""SELECT * FROM (SELECT symbol, timestamp, trade_id, CAST(lead(price, 30) OVER ({_TO}) > price AS INTEGER) AS label
 FROM ticks) WHERE label IS NOT NULL""")
def label_horizon(v: Views):
    order = ["timestamp", "trade_id"]
    return labels.horizon_label(ticks(v), order=order).select("symbol", *order, "label")
