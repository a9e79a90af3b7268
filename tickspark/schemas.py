"""Schemas of the inputs, by market and data type."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
}


def _struct(columns: str) -> T.StructType:
    """``name type, ...``; ``StructType.fromDDL`` would need a running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in pairs])


# Columns of the public files, which carry no header.
_TRADES = "trade_id bigint, price double, qty double, {quote} double, time bigint, is_buyer_maker boolean"
_AGG_TRADES = _struct(
    "agg_trade_id bigint, price double, qty double, first_trade_id bigint, last_trade_id bigint, "
    "time bigint, is_buyer_maker boolean, is_best_match boolean"
)
_KLINES = _struct(
    "open_time bigint, open double, high double, low double, close double, volume double, "
    "close_time bigint, quote_volume double, num_trades bigint, taker_buy_base_volume double, "
    "taker_buy_quote_volume double, ignore string"
)
_PUBLIC = {
    ("spot", "trades"): _struct(_TRADES.format(quote="quote_qty") + ", is_best_match boolean"),
    ("um", "trades"): _struct(_TRADES.format(quote="quote_qty")),
    ("cm", "trades"): _struct(_TRADES.format(quote="base_qty")),
    **{(m, "aggTrades"): _AGG_TRADES for m in ("spot", "um", "cm")},
    **{(m, "klines"): _KLINES for m in ("spot", "um", "cm")},
}

# Order-book snapshot files.
SNAPSHOT = _struct(
    "_ignore string, timestamp_ms bigint, bid_price double, bid_qty double, ask_price double, "
    "ask_qty double, volume double"
)
BOOK = _struct(
    "rec_type bigint, ts_ms bigint, bid_px double, bid_qty double, ask_px double, ask_qty double, vol_base double"
)

# Event logs.
STRATEGY_UPDATES = _struct(
    "timestamp string, symbol string, strategy_id bigint, filled_qty double, remaining_qty double, "
    "open_qty double, new_open_qty double"
)
TRADE_FILLS = _struct("timestamp string, symbol string, side string, fill_qty double, fill_price double")
SIGNALS = _struct(
    "timestamp string, symbol string, signal_value double, strategy_id bigint, entry_allowed boolean, mid_price double"
)
FILLS = _struct("timestamp string, symbol string, qty double, price double, side string, order_id string")

# Live trade messages (event time, symbol, price, quantity, maker flag).
MESSAGES = _struct("T bigint, s string, p string, q string, m boolean")


def public_schema(market: str, kind: str) -> T.StructType:
    """Schema of a public trades, aggTrades or klines file."""
    try:
        return _PUBLIC[market, kind]
    except KeyError:
        raise ValueError(f"no schema for market {market!r} and type {kind!r}") from None
