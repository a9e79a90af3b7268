"""Time bars: one row per (symbol, interval), by hash or sort aggregation with a
map-side partial step, so a hot symbol or a hot interval arrives at the shuffle as
one partial row per task.

First and last values are taken by ``order``. One order column that follows time
(such as a monotone trade id) keeps the aggregation hashed; several columns are
compared as a struct, which Spark aggregates after a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.functions.expr import EPS_BARS, EPS_LOGS, bucket, div, flow_columns, interval_literal, update_columns
from tickspark.operators.ordered import Ordered


def _bucketed(df: DataFrame, every: str, ts: str) -> DataFrame:
    start = bucket(ts, every, like=df.schema[ts].dataType)
    return df.withColumn("__bar", start).where(F.col("__bar").isNotNull())


def _finish(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumnRenamed("__bar", ts)


def _key(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _sum(c: Column | str) -> Column:
    """Sum that is 0 over no values."""
    return F.coalesce(F.sum(c), F.lit(0))


def _when_sum(cond: Column, value: Column | str) -> Column:
    return F.sum(F.when(cond, F.coalesce(value, F.lit(0))).otherwise(F.lit(0)))


def _distinct(c: str) -> Column:
    """Distinct values, NULL counted as one of them."""
    return F.count_distinct(c) + F.max(F.col(c).isNull().cast("bigint"))


def _ohlcv(price: str, qty: str, order: Sequence[str]) -> dict[str, Column]:
    at, p, q = _key(order), F.col(price), F.col(qty)
    return {
        "open": F.min_by(p, at),
        "high": F.max(p),
        "low": F.min(p),
        "close": F.max_by(p, at),
        "volume": _sum(q),
        "quote_volume": _sum(p * q),
        "num_trades": F.count(F.lit(1)),
        "vwap": div(F.sum(p * q), F.sum(q)),
    }


def _agg(df: DataFrame, keys: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys, "__bar").agg(*[c.alias(n) for n, c in columns.items()])


def ohlcv_bars(
    trades: DataFrame,
    every: str = "1s",
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts", "trade_id"),
    ts: str = "ts",
    price: str = "price",
    qty: str = "qty",
) -> DataFrame:
    """Open, high, low, close, volume, quote volume, trade count and VWAP."""
    return _finish(_agg(_bucketed(trades, every, ts), by, _ohlcv(price, qty, order)), ts)


def flow_bars(
    trades: DataFrame,
    every: str = "1s",
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts", "trade_id"),
    ts: str = "ts",
    price: str = "price",
    qty: str = "qty",
    maker: str = "is_buyer_maker",
) -> DataFrame:
    """OHLCV bars plus volume and trade count by aggressor side and their
    imbalances. A buyer that made the market means the seller was the aggressor."""
    bars = _agg(_bucketed(trades, every, ts), by, flow_aggregates(order, price, qty, maker))
    return _finish(flow_derived(bars), ts)


def flow_aggregates(
    order: Sequence[str] = ("ts", "trade_id"),
    price: str = "price",
    qty: str = "qty",
    maker: str = "is_buyer_maker",
) -> dict[str, Column]:
    """The aggregates of a flow bar, for any grouping."""
    sold, q = F.col(maker), F.col(qty)
    return {
        **_ohlcv(price, qty, order),
        "buy_volume": _when_sum(~sold, q),
        "buy_trades": _when_sum(~sold, F.lit(1)),
        "sell_volume": _when_sum(sold, q),
        "sell_trades": _when_sum(sold, F.lit(1)),
    }


def flow_derived(bars: DataFrame) -> DataFrame:
    bars = bars.withColumns({"first_price": F.col("open"), "last_price": F.col("close")})
    return bars.withColumns(flow_columns())


def book_bars(
    book: DataFrame,
    every: str = "1s",
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("timestamp",),
    ts: str = "timestamp",
) -> DataFrame:
    """Order-book bars over snapshots with mid_price, spread, spread_bps,
    book_imbalance and the four quote columns."""
    at = _key(order)
    columns = {
        "open": F.min_by("mid_price", at),
        "high": F.max("mid_price"),
        "low": F.min("mid_price"),
        "close": F.max_by("mid_price", at),
        "volume": _sum("volume"),
        **{c: F.max_by(c, at) for c in ("bid_price", "bid_qty", "ask_price", "ask_qty")},
        "avg_spread": F.avg("spread"),
        "avg_spread_bps": F.avg("spread_bps"),
        "avg_book_imbalance": F.avg("book_imbalance"),
        "tick_count": F.count(F.lit(1)),
    }
    return _finish(_agg(_bucketed(book, every, ts), by, columns), ts)


def signal_bars(
    signals: DataFrame,
    every: str = "1s",
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("timestamp",),
    ts: str = "timestamp",
) -> DataFrame:
    at = _key(order)
    columns = {
        "last_signal": F.max_by("signal_value", at),
        "avg_signal": F.avg("signal_value"),
        "sum_signal": _sum("signal_value"),
        "n_signals": F.count("signal_value"),
        "max_signal": F.max("signal_value"),
        "min_signal": F.min("signal_value"),
        "n_strategies": _distinct("strategy_id"),
        "n_entries_allowed": _when_sum(F.col("entry_allowed"), F.lit(1)),
        "signal_mid_price": F.max_by("mid_price", at),
    }
    return _finish(_agg(_bucketed(signals, every, ts), by, columns), ts)


def fill_bars(
    fills: DataFrame,
    every: str = "1s",
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("timestamp",),
    ts: str = "timestamp",
) -> DataFrame:
    at = _key(order)
    q, p = F.col("qty").cast("double"), F.col("price").cast("double")
    buy, sell = F.col("side") == "BUY", F.col("side") == "SELL"
    columns = {
        "fill_volume": _sum(q),
        "n_fills": F.count(q),
        "avg_fill_price": F.avg(p),
        "last_fill_price": F.max_by(p, at),
        "n_buys": _when_sum(buy, F.lit(1)),
        "n_sells": _when_sum(sell, F.lit(1)),
        "buy_volume": _when_sum(buy, q),
        "sell_volume": _when_sum(sell, q),
        "n_orders": _distinct("order_id"),
        "vwap": div(F.sum(q * p), F.sum(q)),
    }
    bars = _agg(_bucketed(fills, every, ts), by, columns)
    bv, sv = F.col("buy_volume"), F.col("sell_volume")
    return _finish(bars.withColumn("fill_imbalance", div(bv - sv, bv + sv + EPS_BARS)), ts)


def strategy_buckets(updates: DataFrame, every: str = "1s", *, ts: str = "ts") -> DataFrame:
    """Per-bucket counts and sums of strategy updates, fill ratio, change of open."""
    columns = {
        "n_strat_events": F.count(F.lit(1)),
        "sum_filled_qty": _sum("filled_qty"),
        "sum_remaining_qty": _sum("remaining_qty"),
        "sum_open_qty": _sum("open_qty"),
        "sum_new_open_qty": _sum("new_open_qty"),
        "n_strategies": _distinct("strategy_id"),
    }
    out = _agg(_bucketed(updates, every, ts), ["symbol"], columns)
    return _finish(out.withColumns(update_columns()), ts)


def fill_buckets(
    fills: DataFrame,
    every: str = "1s",
    *,
    order: Sequence[str] = ("ts",),
    ts: str = "ts",
    qty: str = "fill_qty",
    price: str = "fill_price",
) -> DataFrame:
    """Per-bucket fill counts, sizes, prices and side imbalance."""
    q = F.col(qty)
    columns = {
        "n_fills": F.count(F.lit(1)),
        "sum_fill_qty": _sum(q),
        "mean_fill_price": F.avg(price),
        "last_fill_price": F.max_by(price, _key(order)),
        "buy_qty": _when_sum(F.col("side") == "BUY", q),
        "sell_qty": _when_sum(F.col("side") == "SELL", q),
    }
    out = _agg(_bucketed(fills, every, ts), ["symbol"], columns)
    b, s = F.col("buy_qty"), F.col("sell_qty")
    out = out.withColumns({"net_fill_qty": b - s, "fill_imbalance": div(b - s, b + s + EPS_LOGS)})
    return _finish(out, ts)


def resample_bars(bars: DataFrame, every: str, *, by: Sequence[str] = ("symbol",), ts: str = "ts") -> DataFrame:
    """Coarser OHLCV bars from finer ones; empty intervals do not appear."""
    columns = {
        "open": F.min_by("open", ts),
        "high": F.max("high"),
        "low": F.min("low"),
        "close": F.max_by("close", ts),
        "volume": _sum("volume"),
    }
    return _finish(_agg(_bucketed(bars, every, ts), by, columns), ts)


def fill_volume_by_interval(fills: DataFrame, every: str = "1m", *, ts: str = "ts", qty: str = "qty") -> DataFrame:
    """Filled quantity per (symbol, interval)."""
    return _finish(_agg(_bucketed(fills, every, ts), ["symbol"], {"volume": _sum(qty)}), ts)


def fill_volume_by(fills: DataFrame, column: str, *, qty: str = "qty") -> DataFrame:
    """Filled quantity and fills per symbol or per side."""
    return fills.groupBy(column).agg(_sum(qty).alias("volume"), F.count(F.lit(1)).alias("n_fills"))


def twap_bars(
    trades: DataFrame,
    every: str = "1s",
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts", "trade_id"),
    ts: str = "ts",
    price: str = "price",
) -> DataFrame:
    """Time-weighted average price: each price counts for the time until the next
    trade of the series or the end of its bar, whichever comes first."""
    ticks = _bucketed(trades.select(*by, *dict.fromkeys([*order, ts, price])), every, ts)
    length = F.expr(f"INTERVAL {interval_literal(every)}")

    def durations(df: DataFrame, w) -> DataFrame:
        until = F.least(F.lead(ts).over(w), F.col("__bar") + length)
        held = F.unix_micros(until.cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
        return df.withColumn("__held", held)

    held = Ordered(ticks, by, order, plain=True).windows(durations, forward=1)
    columns = {"twap": div(F.sum(F.col(price) * F.col("__held")), F.sum("__held"))}
    return _finish(_agg(held, by, columns), ts)

