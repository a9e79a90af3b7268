"""Bars, scalar columns and window features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickspark.functions.expr import (
    advanced_columns,
    book_calendar,
    calendar,
    epoch_to_ts,
    feature_source,
    finite_or_zero,
    micros,
    parse_ts,
    to_double,
)
from tickspark.operators import bars, quality, windows
from tickspark.operators.ordered import Ordered
from workload.registry import SHARED, query
from workload.views import LINE_ORDER, Views

EVENT = ("ts", "trade_id")

# -- shared SQL ---------------------------------------------------------------------

SHARED["ohlcv"] = """SELECT symbol, date_trunc('hour', t.ts) AS ts, arg_min(price, (t.ts, trade_id)) AS open,
 max(price) AS high, min(price) AS low, arg_max(price, (t.ts, trade_id)) AS close, sum(qty) AS volume,
 sum(price * qty) AS quote_volume, count(*) AS num_trades, sum(price * qty) / NULLIF(sum(qty), 0) AS vwap
 FROM trades t GROUP BY symbol, date_trunc('hour', t.ts)"""

_FLOW_AGG = """arg_min(price, {o}) AS open, max(price) AS high, min(price) AS low, arg_max(price, {o}) AS close,
 sum(qty) AS volume, sum(price * qty) AS quote_volume, count(*) AS num_trades,
 sum(CASE WHEN NOT is_buyer_maker THEN qty ELSE 0.0::DOUBLE END) AS buy_volume,
 CAST(sum(CASE WHEN NOT is_buyer_maker THEN 1 ELSE 0 END) AS BIGINT) AS buy_trades,
 sum(CASE WHEN is_buyer_maker THEN qty ELSE 0.0::DOUBLE END) AS sell_volume,
 CAST(sum(CASE WHEN is_buyer_maker THEN 1 ELSE 0 END) AS BIGINT) AS sell_trades,
 sum(price * qty) / NULLIF(sum(qty), 0) AS vwap"""
_FLOW_MORE = """*, open AS first_price, close AS last_price, buy_volume - sell_volume AS net_volume,
 (buy_volume - sell_volume) / (buy_volume + sell_volume + 1e-10::DOUBLE) AS volume_imbalance,
 (buy_trades - sell_trades) / (buy_trades + sell_trades + 1e-10::DOUBLE) AS trade_imbalance,
 high - low AS price_range,
 CASE WHEN close / NULLIF(open, 0) > 0 THEN ln(close / NULLIF(open, 0)) END AS log_return"""
SHARED["flow0"] = (
    f"SELECT symbol, date_trunc('hour', t.ts) AS ts, {_FLOW_AGG.format(o='(t.ts, trade_id)')} "
    "FROM trades t GROUP BY symbol, date_trunc('hour', t.ts)"
)
SHARED["flow"] = f"SELECT {_FLOW_MORE} FROM flow0"
SHARED["lineflow0"] = (
    f"SELECT symbol, date_trunc('day', t.ts) AS ts, "
    f"{_FLOW_AGG.format(o='(t.ts, l_orderkey, l_linenumber, l_partkey, l_suppkey)')} "
    "FROM lines t GROUP BY symbol, date_trunc('day', t.ts)"
)
SHARED["lineflow"] = f"SELECT {_FLOW_MORE} FROM lineflow0"
SHARED["advanced"] = """SELECT *, (high - low) / NULLIF(close, 0) AS rel_range,
 volume / (num_trades + 1e-10::DOUBLE) AS avg_trade_size,
 (buy_volume / (buy_trades + 1e-10::DOUBLE)) / (sell_volume / (sell_trades + 1e-10::DOUBLE) + 1e-10::DOUBLE) AS buy_sell_size_ratio,
 net_volume * sign(log_return) AS signed_volume, (close - vwap) / NULLIF(close, 0) AS price_efficiency,
 num_trades / (volume + 1e-10::DOUBLE) AS trade_intensity FROM flow"""

OHLCV = ["open", "high", "low", "close", "volume", "quote_volume"]
FLOW_D = [*OHLCV, "buy_volume", "sell_volume", "vwap", "first_price", "last_price", "net_volume",
          "volume_imbalance", "trade_imbalance", "price_range", "log_return"]
FLOW_SQL = "symbol, ts, num_trades, buy_trades, sell_trades, " + ", ".join(f"R({c}) AS {c}" for c in FLOW_D)


def rounded(*names: str) -> str:
    return ", ".join(f"R({c}) AS {c}" for c in names)


def frame(n: int, w: int, part: str = "symbol", order: str = "ts") -> str:
    return f"w{n} AS (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"


def full(agg: str, x: str, w: int) -> str:
    return f"CASE WHEN count({x}) OVER w{w} >= {w} THEN {agg}({x}) OVER w{w} END"


def flow(v: Views):
    return bars.flow_bars(v.trades, "1h", order=EVENT)


# -- bars ------------------------------------------------------------------------------


@query(f"SELECT symbol, ts, num_trades, {rounded(*OHLCV, 'vwap')} FROM ohlcv")
def bars_ohlcv(v: Views):
    return bars.ohlcv_bars(v.trades, "1h", order=EVENT)


@query(f"SELECT {FLOW_SQL} FROM flow")
def bars_flow(v: Views):
    return flow(v)


@query(f"SELECT {FLOW_SQL} FROM lineflow")
def bars_flow_lines(v: Views):
    return bars.flow_bars(v.lines, "1d", order=LINE_ORDER)


SHARED["snap"] = """SELECT symbol, ts AS timestamp, seq, bid_px AS bid_price, ask_px AS ask_price, bid_qty, ask_qty,
 vol_base AS volume, (bid_px + ask_px) / 2 AS mid_price, ask_px - bid_px AS spread,
 (ask_px - bid_px) / NULLIF((bid_px + ask_px) / 2, 0) * 10000 AS spread_bps,
 (bid_qty - ask_qty) / NULLIF(bid_qty + ask_qty, 0) AS book_imbalance FROM book"""
SHARED["bookbars"] = """SELECT symbol, date_trunc('hour', t.timestamp) AS timestamp,
 arg_min(mid_price, (t.timestamp, seq)) AS open, max(mid_price) AS high, min(mid_price) AS low,
 arg_max(mid_price, (t.timestamp, seq)) AS close, sum(volume) AS volume,
 arg_max(bid_price, (t.timestamp, seq)) AS bid_price, arg_max(bid_qty, (t.timestamp, seq)) AS bid_qty,
 arg_max(ask_price, (t.timestamp, seq)) AS ask_price, arg_max(ask_qty, (t.timestamp, seq)) AS ask_qty,
 avg(spread) AS avg_spread, avg(spread_bps) AS avg_spread_bps, avg(book_imbalance) AS avg_book_imbalance,
 count(*) AS tick_count FROM snap t GROUP BY symbol, date_trunc('hour', t.timestamp)"""
BOOK_D = ["open", "high", "low", "close", "volume", "bid_price", "bid_qty", "ask_price", "ask_qty", "avg_spread",
          "avg_spread_bps", "avg_book_imbalance"]


@query(f"SELECT symbol, timestamp, tick_count, {rounded(*BOOK_D)} FROM bookbars")
def bars_book(v: Views):
    return bars.book_bars(v.snapshots, "1h", order=("timestamp", "seq"))


SHARED["sigbars"] = """SELECT symbol, date_trunc('hour', t.ts) AS timestamp, arg_max(signal_value, (t.ts, signal_id)) AS last_signal,
 avg(signal_value) AS avg_signal, CAST(sum(signal_value) AS BIGINT) AS sum_signal, count(signal_value) AS n_signals,
 max(signal_value) AS max_signal, min(signal_value) AS min_signal, count(DISTINCT strategy_id) AS n_strategies,
 CAST(sum(CASE WHEN entry_allowed THEN 1 ELSE 0 END) AS BIGINT) AS n_entries_allowed,
 arg_max(mid_price, (t.ts, signal_id)) AS signal_mid_price FROM signals t GROUP BY symbol, date_trunc('hour', t.ts)"""


def signal_bars(v: Views):
    return bars.signal_bars(v.signals.withColumnRenamed("ts", "timestamp"), "1h", order=("timestamp", "signal_id"))


@query("""SELECT symbol, timestamp, last_signal, R(avg_signal) AS avg_signal, sum_signal, n_signals, max_signal,
 min_signal, n_strategies, n_entries_allowed, R(signal_mid_price) AS signal_mid_price FROM sigbars""")
def bars_signal(v: Views):
    return signal_bars(v)


SHARED["fillbars0"] = """SELECT symbol, date_trunc('hour', t.ts) AS timestamp, sum(qty) AS fill_volume, count(qty) AS n_fills,
 avg(price) AS avg_fill_price, arg_max(price, (t.ts, fill_id)) AS last_fill_price,
 CAST(sum(CASE WHEN side = 'BUY' THEN 1 ELSE 0 END) AS BIGINT) AS n_buys,
 CAST(sum(CASE WHEN side = 'SELL' THEN 1 ELSE 0 END) AS BIGINT) AS n_sells,
 sum(CASE WHEN side = 'BUY' THEN qty ELSE 0 END) AS buy_volume,
 sum(CASE WHEN side = 'SELL' THEN qty ELSE 0 END) AS sell_volume, count(DISTINCT order_id) AS n_orders,
 sum(qty * price) / NULLIF(sum(qty), 0) AS vwap FROM fills t GROUP BY symbol, date_trunc('hour', t.ts)"""
SHARED["fillbars"] = """SELECT *, (buy_volume - sell_volume) / (buy_volume + sell_volume + 1e-10::DOUBLE) AS fill_imbalance
 FROM fillbars0"""
FILL_D = ["fill_volume", "avg_fill_price", "last_fill_price", "buy_volume", "sell_volume", "vwap", "fill_imbalance"]


def fill_bars(v: Views):
    return bars.fill_bars(v.fills.withColumnRenamed("ts", "timestamp"), "1h", order=("timestamp", "fill_id"))


@query(f"SELECT symbol, timestamp, n_fills, n_buys, n_sells, n_orders, {rounded(*FILL_D)} FROM fillbars")
def bars_fill(v: Views):
    return fill_bars(v)


SHARED["strat0"] = """SELECT symbol, date_trunc('hour', t.ts) AS ts, count(*) AS n_strat_events,
 sum(filled_qty) AS sum_filled_qty, sum(remaining_qty) AS sum_remaining_qty, sum(open_qty) AS sum_open_qty,
 sum(new_open_qty) AS sum_new_open_qty, count(DISTINCT strategy_id) AS n_strategies FROM updates t
 GROUP BY symbol, date_trunc('hour', t.ts)"""
SHARED["strat"] = """SELECT *, sum_filled_qty / (sum_filled_qty + sum_remaining_qty + 1e-9::DOUBLE) AS fill_ratio,
 sum_new_open_qty - sum_open_qty AS delta_open FROM strat0"""
STRAT_D = ["sum_filled_qty", "sum_remaining_qty", "sum_open_qty", "sum_new_open_qty", "fill_ratio", "delta_open"]
SHARED["done0"] = """SELECT symbol, date_trunc('hour', t.ts) AS ts, count(*) AS n_fills, sum(qty) AS sum_fill_qty,
 avg(price) AS mean_fill_price, arg_max(price, (t.ts, fill_id)) AS last_fill_price,
 sum(CASE WHEN side = 'BUY' THEN qty ELSE 0 END) AS buy_qty,
 sum(CASE WHEN side = 'SELL' THEN qty ELSE 0 END) AS sell_qty FROM fills t GROUP BY symbol, date_trunc('hour', t.ts)"""
SHARED["done"] = """SELECT *, buy_qty - sell_qty AS net_fill_qty,
 (buy_qty - sell_qty) / (buy_qty + sell_qty + 1e-9::DOUBLE) AS fill_imbalance FROM done0"""
DONE_D = ["sum_fill_qty", "mean_fill_price", "last_fill_price", "buy_qty", "sell_qty", "net_fill_qty", "fill_imbalance"]


@query(f"SELECT symbol, ts, n_strat_events, n_strategies, {rounded(*STRAT_D)} FROM strat")
def bars_strategy(v: Views):
    return bars.strategy_buckets(v.updates, "1h")


@query(f"SELECT symbol, ts, n_fills, {rounded(*DONE_D)} FROM done")
def bars_fill_bucket(v: Views):
    return bars.fill_buckets(v.log_fills, "1h", order=("ts", "fill_id"))


@query("""SELECT symbol, date_trunc('day', b.ts) AS ts, R(arg_min(open, b.ts)) AS open, R(max(high)) AS high, R(min(low)) AS low,
 R(arg_max(close, b.ts)) AS close, R(sum(volume)) AS volume FROM ohlcv b GROUP BY symbol, date_trunc('day', b.ts)""")
def bars_resample(v: Views):
    return bars.resample_bars(bars.ohlcv_bars(v.trades, "1h", order=EVENT), "1d")


@query("""SELECT symbol, date_trunc('minute', t.ts) AS ts, R(sum(qty)) AS volume FROM fills t
 GROUP BY symbol, date_trunc('minute', t.ts)""")
def volume_1min(v: Views):
    return bars.fill_volume_by_interval(v.fills, "1m")


@query("SELECT side, R(sum(qty)) AS volume, count(*) AS n_fills FROM fills GROUP BY side")
def volume_by_side(v: Views):
    return bars.fill_volume_by(v.fills, "side")


@query("SELECT symbol, R(sum(qty)) AS volume, count(*) AS n_fills FROM fills GROUP BY symbol")
def volume_by_symbol(v: Views):
    return bars.fill_volume_by(v.fills, "symbol")


@query("""WITH d AS (SELECT symbol, date_trunc('hour', ts) AS bar, price, epoch_us(least(lead(ts) OVER (PARTITION BY symbol
 ORDER BY ts, trade_id), date_trunc('hour', ts) + INTERVAL 1 HOUR)) - epoch_us(ts) AS held FROM trades)
 SELECT symbol, bar AS ts, R(sum(price * held) / NULLIF(sum(held), 0)) AS twap FROM d GROUP BY symbol, bar""")
def bars_twap(v: Views):
    return bars.twap_bars(v.trades, "1h", order=EVENT)


# -- rolling -------------------------------------------------------------------------------

W = (5, 15, 60)


def _roll_flow_sql() -> str:
    out = []
    for w in W:
        out += [
            f"R({full('sum', 'volume', w)}) AS vol_sum_{w}",
            f"R({full('avg', 'volume_imbalance', w)}) AS vol_imb_mean_{w}",
            f"R({full('avg', 'trade_imbalance', w)}) AS trade_imb_mean_{w}",
            f"R({full('stddev_samp', 'log_return', w)}) AS ret_std_{w}",
            f"R({full('sum', 'net_volume', w)}) AS net_vol_sum_{w}",
            f"R((close - {full('avg', 'vwap', w)}) / NULLIF(close, 0)) AS vwap_dev_{w}",
        ]
    return f"SELECT symbol, ts, {', '.join(out)} FROM flow WINDOW {', '.join(frame(w, w) for w in W)}"


@query(_roll_flow_sql())
def roll_flow(v: Views):
    out = windows.rolling_flow(flow(v), W, trades=v.trades)
    return out.select("symbol", "ts", *[c for c in out.columns if c.rsplit("_", 1)[-1] in map(str, W)])


def _roll_advanced_sql() -> str:
    step, out = [], []
    e = "1e-10::DOUBLE"
    for w in W:
        step.append(f"{full('avg', 'volume', w)} AS mv_{w}")
        out += [
            f"R({full('avg', 'abs(volume_imbalance)', w)}) AS toxicity_{w}",
            f"R({full('stddev_samp', 'volume_imbalance', w)}) AS imb_volatility_{w}",
            f"R({full('avg', 'num_trades', w)}) AS trade_rate_{w}",
            f"R(mv_{w} - lag(mv_{w}, {w}) OVER o) AS vol_accel_{w}",
            f"R(avg_trade_size / ({full('avg', 'avg_trade_size', w)} + {e})) AS trade_size_ratio_{w}",
            f"R({full('sum', 'log_return', w)}) AS momentum_{w}",
            f"R({full('avg', 'crossed', w)}) AS ret_autocorr_{w}",
            f"R({full('sum', 'signed_volume', w)}) AS kyle_lambda_{w}",
            f"R({full('sum', 'log_return', w)} / ({full('sum', 'volume', w)} + {e})) AS price_impact_{w}",
            f"R({full('avg', 'abs(price_efficiency)', w)}) AS vwap_tracking_{w}",
            f"R(rel_range / NULLIF({full('avg', 'rel_range', w)} + {e}, 0)) AS range_ratio_{w}",
            f"R({full('avg', 'trade_intensity', w)} / ({full('avg', 'trade_intensity', 2 * w)} + {e})) AS intensity_momentum_{w}",
        ]
    sizes = sorted({*W, *(2 * w for w in W)})
    frames = ", ".join(frame(w, w) for w in sizes)
    order = "o AS (PARTITION BY symbol ORDER BY ts)"
    inner = f"SELECT *, log_return * lag(log_return) OVER o AS crossed, {', '.join(step)} FROM advanced WINDOW {order}, {frames}"
    return f"WITH s AS ({inner}) SELECT symbol, ts, {', '.join(out)} FROM s WINDOW {order}, {frames}"


ADVANCED = ("toxicity", "imb_volatility", "trade_rate", "vol_accel", "trade_size_ratio", "momentum", "ret_autocorr",
            "kyle_lambda", "price_impact", "vwap_tracking", "range_ratio", "intensity_momentum")


@query(_roll_advanced_sql())
def roll_advanced(v: Views):
    out = windows.rolling_flow(flow(v), W, advanced=True, trades=v.trades)
    return out.select("symbol", "ts", *[f"{a}_{w}" for w in W for a in ADVANCED])


ADV_D = ["rel_range", "avg_trade_size", "signed_volume", "price_efficiency", "trade_intensity"]


@query(f"SELECT symbol, ts, {rounded(*ADV_D)}, R(ln(1 + buy_sell_size_ratio)) AS log_size_ratio FROM advanced")
def flow_advanced(v: Views):
    # Without sell volume the ratio is of the order of 1e12, so its logarithm is compared.
    size = F.log1p("buy_sell_size_ratio").alias("log_size_ratio")
    return flow(v).withColumns(advanced_columns()).select("symbol", "ts", *ADV_D, size)


@query("""SELECT symbol, ts, CASE WHEN count(CASE WHEN signed_volume IS NOT NULL AND log_return IS NOT NULL THEN 1 END)
 OVER w15 >= 15 THEN CASE WHEN var_pop(signed_volume) OVER w15 > 0 THEN R(covar_pop(log_return, signed_volume) OVER w15
 / var_pop(signed_volume) OVER w15 * 1000) END END AS slope_x1000 FROM advanced WINDOW """ + frame(15, 15))
def kyle_slope(v: Views):
    rows = Ordered(flow(v).withColumns(advanced_columns()), ["symbol"], ["ts"]).windows(
        lambda d, w: d.withColumns(windows.kyle_lambda_ols(w, [15])), back=15
    )
    return rows.select("symbol", "ts", (F.col("kyle_lambda_ols_15") * 1000).alias("slope_x1000"))


# Segments of the sparse fixture: a gap of more than 30 minutes starts a new one.
SHARED["gaps"] = """SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY ts, seq) AS gap FROM book"""
SHARED["segs"] = """SELECT *, CAST(sum(CASE WHEN gap <= 1800000000 THEN 0 ELSE 1 END) OVER (PARTITION BY symbol
 ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_id FROM gaps"""
_B = "1e-12::DOUBLE"
SHARED["feats"] = f"""SELECT *, (bid_px + ask_px) / 2 AS mid,
 CASE WHEN (bid_px + ask_px) / 2 > 0 THEN ln((bid_px + ask_px) / 2) END AS log_mid, ask_px - bid_px AS spread,
 (ask_px - bid_px) / NULLIF((bid_px + ask_px) / 2 + {_B}, 0) AS rel_spread,
 (bid_qty - ask_qty) / NULLIF(bid_qty + ask_qty + {_B}, 0) AS imb,
 (ask_px * bid_qty + bid_px * ask_qty) / NULLIF(bid_qty + ask_qty + {_B}, 0) AS microprice,
 ((ask_px * bid_qty + bid_px * ask_qty) / NULLIF(bid_qty + ask_qty + {_B}, 0) - (bid_px + ask_px) / 2)
   / NULLIF((bid_px + ask_px) / 2 + {_B}, 0) AS micro_mid_dev,
 CASE WHEN vol_base > -1 THEN ln(1 + vol_base) END AS vol_log1p, vol_base * ((bid_px + ask_px) / 2) AS notional,
 CASE WHEN vol_base * ((bid_px + ask_px) / 2) > -1 THEN ln(1 + vol_base * ((bid_px + ask_px) / 2)) END AS notional_log1p
 FROM segs"""
SEG = "PARTITION BY symbol, segment_id ORDER BY ts, seq"
SHARED["diffs"] = f"SELECT *, log_mid - lag(log_mid) OVER ({SEG}) AS r1 FROM feats"
BOOK_KEY = ("ts", "seq")
BOOK_F = ["mid", "log_mid", "spread", "rel_spread", "imb", "microprice", "micro_mid_dev", "vol_log1p", "notional",
          "notional_log1p"]


def segmented(v: Views):
    return quality.gap_segments(v.book_features, "30m", order=BOOK_KEY, plain=True)


@query(f"SELECT symbol, ts, seq, {rounded(*BOOK_F)} FROM feats")
def book_feats(v: Views):
    return v.book_features.select("symbol", "ts", "seq", *BOOK_F)


SEG_W = (5, 15)


def _seg_sql() -> str:
    out = []
    for w in SEG_W:
        out += [
            f"R(stddev_samp(r1) OVER w{w}) AS r1_std_{w}",
            f"R(sum(vol_base) OVER w{w}) AS vol_sum_{w}",
            f"R(sum(notional) OVER w{w}) AS not_sum_{w}",
            f"R(avg(imb) OVER w{w}) AS imb_mean_{w}",
            f"R(avg(rel_spread) OVER w{w}) AS spr_mean_{w}",
        ]
    frames = ", ".join(frame(w, w, "symbol, segment_id", "ts, seq") for w in SEG_W)
    return f"SELECT symbol, ts, seq, {', '.join(out)} FROM diffs WINDOW {frames}"


@query(_seg_sql())
def roll_segment(v: Views):
    out = windows.segment_rolling(segmented(v), SEG_W, order=BOOK_KEY)
    return out.select("symbol", "ts", "seq", *[c for c in out.columns if c.endswith(("_5", "_15"))])


@query("SELECT symbol, ts, seq, segment_id, R(r1) AS r1 FROM diffs")
def diff_segment(v: Views):
    return windows.segment_rolling(segmented(v), [5], order=BOOK_KEY).select("symbol", "ts", "seq", "segment_id", "r1")


def _generic_sql() -> str:
    out = []
    for c in ("close", "volume"):
        for w in (5, 10):
            out.append(f"R({full('avg', c, w)}) AS {c}_ma{w}")
            out.append(f"R({full('stddev_samp', c, w)}) AS {c}_std{w}")
    return f"SELECT symbol, ts, {', '.join(out)} FROM flow WINDOW {frame(5, 5)}, {frame(10, 10)}"


@query(_generic_sql())
def roll_generic(v: Views):
    out = windows.add_rolling(flow(v), ["close", "volume", "close_ma5"], [5, 10])
    return out.select("symbol", "ts", *[f"{c}_{k}{w}" for c in ("close", "volume") for w in (5, 10) for k in ("ma", "std")])


@query("SELECT symbol, ts, " + ", ".join(
    f"R(lag({c}, {k}) OVER (PARTITION BY symbol ORDER BY ts)) AS {c}_lag{k}" for c in ("close", "volume") for k in (1, 5)
) + " FROM flow")
def lags(v: Views):
    out = windows.add_lags(flow(v), ["close", "volume"], [1, 5])
    return out.select("symbol", "ts", *[f"{c}_lag{k}" for c in ("close", "volume") for k in (1, 5)])


SHARED["ticks"] = """SELECT symbol, ts AS timestamp, trade_id, price, qty, CASE WHEN is_buyer_maker THEN -1 ELSE 1 END AS trade_direction,
 price / NULLIF(lag(price) OVER (PARTITION BY symbol ORDER BY ts, trade_id), 0) - 1 AS return_1 FROM trades"""


def ticks(v: Views):
    side = F.when(F.col("is_buyer_maker"), -1).otherwise(1)
    return v.trades.withColumnRenamed("ts", "timestamp").withColumn("trade_direction", side)


def _tick_sql() -> str:
    out = ["R(return_1) AS return_1", "R(CASE WHEN price > 0 THEN ln(price) END) AS log_price", "R(price * qty) AS dollar_volume"]
    for w in (5, 10, 30):
        out += [
            f"R(avg(price) OVER w{w}) AS price_ma_{w}",
            f"R(stddev_samp(price) OVER w{w}) AS price_std_{w}",
            f"R(sum(qty) OVER w{w}) AS volume_sum_{w}",
            f"R(avg(return_1) OVER w{w}) AS return_ma_{w}",
        ]
    for k in (1, 5, 10):
        out += [f"R(lag(price, {k}) OVER o) AS price_lag_{k}", f"R(lag(return_1, {k}) OVER o) AS return_lag_{k}"]
    out += [f"R(sum(trade_direction * qty) OVER w{w}) AS order_flow_{w}" for w in (10, 30)]
    by = "timestamp, trade_id"
    frames = ", ".join(frame(w, w, order=by) for w in (5, 10, 30))
    return f"SELECT symbol, timestamp, trade_id, {', '.join(out)} FROM ticks WINDOW o AS (PARTITION BY symbol ORDER BY {by}), {frames}"


@query(_tick_sql())
def tick_features(v: Views):
    out = windows.tick_features(ticks(v), order=("timestamp", "trade_id"), plain=True)
    return out.drop("price", "qty", "is_buyer_maker", "trade_direction", "processed_at")


SHARED["thin"] = "SELECT symbol, ts, CASE WHEN num_trades > 2 THEN close END AS close, CASE WHEN num_trades > 4 THEN volume END AS volume FROM flow"


@query("""SELECT symbol, ts, R(last_value(close IGNORE NULLS) OVER w) AS close, R(last_value(volume IGNORE NULLS) OVER w) AS volume
 FROM thin WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING)""")
def ffill(v: Views):
    thin = flow(v).select(
        "symbol",
        "ts",
        F.when(F.col("num_trades") > 2, F.col("close")).alias("close"),
        F.when(F.col("num_trades") > 4, F.col("volume")).alias("volume"),
    )
    return windows.forward_fill(thin)


@query("""SELECT symbol, ts, R(close / NULLIF(first_value(close) OVER (PARTITION BY symbol ORDER BY ts
 ROWS UNBOUNDED PRECEDING), 0) - 1) AS cum_return FROM flow""")
def cum_return(v: Views):
    return windows.cumulative_return(flow(v)).select("symbol", "ts", "cum_return")


@query("""SELECT symbol, ts, y, n, R(checksum) AS checksum FROM (SELECT symbol, ts, R(log_return) AS y, count(*) OVER w AS n,
 sum(close) OVER w + sum(volume) OVER w AS checksum FROM flow
 WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)) WHERE n = 20""")
def sequences_20(v: Views):
    out = windows.sequences(flow(v), ["close", "volume"], "log_return", length=20)
    total = F.aggregate(F.flatten("sequence"), F.lit(0.0), lambda a, x: a + x)
    return out.select("symbol", "ts", F.col("log_return").alias("y"), F.size("sequence").alias("n"), total.alias("checksum"))


def _engineered_sql() -> str:
    # Price columns by name and order: open, close, first_price, ...; volumes: volume, quote_volume, ...
    out = [f"R(coalesce({c}, 0)) AS {c}" for c in ("open", "close", "volume", "quote_volume")]
    for c in ("open", "close", "volume", "quote_volume"):
        out += [f"R(coalesce(lag({c}, {k}) OVER o, 0)) AS {c}_lag{k}" for k in (1, 5)]
    for c in ("open", "close", "volume"):
        for w in (5, 10):
            out.append(f"R(coalesce({full('avg', c, w)}, 0)) AS {c}_ma{w}")
            out.append(f"R(coalesce({full('stddev_samp', c, w)}, 0)) AS {c}_std{w}")
    return f"SELECT symbol, ts, {', '.join(out)} FROM flow WINDOW o AS (PARTITION BY symbol ORDER BY ts), {frame(5, 5)}, {frame(10, 10)}"


@query(_engineered_sql())
def engineered(v: Views):
    base = flow(v).select("symbol", "ts", "open", "close", "volume", "quote_volume")
    return windows.engineered(base, lags=(1, 5), windows=(5, 10))


# -- scalar ---------------------------------------------------------------------------------


@query("""SELECT trade_id, hour(ts) AS hour, minute(ts) AS minute, second(ts) AS second, isodow(ts) AS weekday,
 isodow(ts) - 1 AS dow, R(sin(2 * pi() * hour(ts) / 24)) AS hour_sin, R(cos(2 * pi() * hour(ts) / 24)) AS hour_cos FROM trades""")
def time_feats(v: Views):
    return v.trades.select("trade_id", *[c.alias(n) for n, c in ({**book_calendar("ts"), **calendar("ts")}).items()])


@query("""SELECT trade_id, CAST(date_trunc('milliseconds', ts) AS TIMESTAMP) AS ts FROM trades""")
def epoch_switch(v: Views):
    """Half of the rows carry milliseconds, half microseconds, by a file date."""
    late = F.col("trade_id") % 2 == 0
    epoch = F.when(late, micros("ts")).otherwise(F.floor(micros("ts") / 1000).cast("bigint"))
    day = F.when(late, F.lit("2025-03-01")).otherwise(F.lit("2024-03-01")).cast("date")
    return v.trades.select("trade_id", epoch_to_ts(epoch, day).alias("ts"))


@query("""SELECT event_id, TRY_CAST(props AS DOUBLE) AS bad, ts FROM events""")
def coercion(v: Views):
    rows = v.table("events")
    return rows.select("event_id", to_double("props").alias("bad"), parse_ts(F.col("ts").cast("string")).alias("ts"))


@query("SELECT trade_id, R(CASE WHEN qty = 0 THEN 0 ELSE price / qty END) AS ratio FROM trades")
def finite_values(v: Views):
    ratio = F.when(F.col("qty") == 0, F.lit(float("inf"))).otherwise(F.try_divide("price", "qty"))
    return v.trades.select("trade_id", finite_or_zero(ratio).alias("ratio"))


@query("""SELECT symbol, CASE WHEN regexp_matches(symbol, 'signal|strategy|entry') THEN 'signals'
 WHEN regexp_matches(symbol, 'fill|volume|buy|sell') THEN 'fills'
 WHEN regexp_matches(symbol, 'bid|ask|spread|book') THEN 'order book' ELSE 'other' END AS source, count(*) AS n
 FROM (SELECT event_type || '_' || CASE user_id % 4 WHEN 0 THEN 'signal' WHEN 1 THEN 'volume' WHEN 2 THEN 'bid' ELSE 'x' END
 AS symbol FROM events) GROUP BY 1, 2""")
def feature_sources(v: Views):
    part = F.element_at(F.array(F.lit("signal"), F.lit("volume"), F.lit("bid"), F.lit("x")), (F.col("user_id") % 4 + 1).cast("int"))
    names = v.table("events").select(F.concat_ws("_", "event_type", part).alias("symbol"))
    return names.groupBy("symbol", feature_source("symbol").alias("source")).agg(F.count(F.lit(1)).alias("n"))
