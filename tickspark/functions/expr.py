"""Scalar expressions: guarded arithmetic, time handling, derived tick and book
columns, and column selection. Everything is a built-in Spark expression."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Eps added to denominators of trade bars, log buckets and L1 books.
EPS_BARS = 1e-10
EPS_LOGS = 1e-9
EPS_BOOK = 1e-12

# Fixed value: spot files from this day on carry epoch microseconds.
MICROS_FROM = dt.date(2025, 1, 1)

# Interval suffixes.
_UNITS = {
    "us": "microseconds",
    "ms": "milliseconds",
    "s": "seconds",
    "m": "minutes",
    "min": "minutes",
    "h": "hours",
    "d": "days",
}
_CALENDAR_UNITS = {"w": "week", "mo": "month"}


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# -- arithmetic ------------------------------------------------------------------


def div(a: Column | str, b: Column | str) -> Column:
    """Division that gives NULL for a zero divisor."""
    return F.try_divide(_c(a), _c(b))


def ln(x: Column | str) -> Column:
    """Natural logarithm, NULL outside its domain."""
    x = _c(x)
    return F.when(x > 0, F.log(x))


def to_double(x: Column | str) -> Column:
    """Numeric coercion; a malformed value becomes NULL."""
    return _c(x).try_cast("double")


def finite_or_zero(x: Column | str) -> Column:
    """NULL, NaN and infinities become 0."""
    x = _c(x)
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(x)


# -- time ------------------------------------------------------------------------


def interval_literal(every: str) -> str:
    """``"1s"``, ``"100ms"``, ``"5m"``, ``"1h"``, ``"1d"`` -> Spark interval text."""
    n, unit = _split_interval(every)
    if unit not in _UNITS:
        raise ValueError(f"no fixed length: {every}")
    return f"{n} {_UNITS[unit]}"


def interval_micros(every: str) -> int:
    n, unit = _split_interval(every)
    step = dt.timedelta(**{_UNITS[unit]: n})
    return step // dt.timedelta(microseconds=1)


def _split_interval(every: str) -> tuple[int, str]:
    m = re.fullmatch(r"(\d+)([a-z]+)", every.strip())
    if not m or m.group(2) not in _UNITS | _CALENDAR_UNITS or int(m.group(1)) == 0:
        raise ValueError(f"bad interval: {every}")
    return int(m.group(1)), m.group(2)


def bucket(ts: Column | str, every: str, like: T.DataType | None = None) -> Column:
    """Start of the interval holding ``ts``; intervals align to the epoch, weeks to
    Monday. The type of ``ts`` is kept; ``like`` says it for calendar units, whose
    truncation would otherwise turn a naive timestamp into a zoned one."""
    n, unit = _split_interval(every)
    if unit in _CALENDAR_UNITS:
        if n != 1:
            raise ValueError(f"only single calendar units: {every}")
        return F.date_trunc(_CALENDAR_UNITS[unit], _c(ts)).cast(like or T.TimestampNTZType())
    return F.window(_c(ts), interval_literal(every)).getField("start")


def epoch_to_ts(epoch: Column | str, file_date: Column | None = None, market: str = "spot") -> Column:
    """Epoch milliseconds to a naive timestamp; spot files dated ``MICROS_FROM`` or
    later carry microseconds, which are truncated to milliseconds."""
    millis = _c(epoch)
    if market == "spot" and file_date is not None:
        micros = file_date >= F.lit(MICROS_FROM)
        millis = F.when(micros, F.floor(millis / 1000).cast("bigint")).otherwise(millis)
    return F.timestamp_millis(millis).cast("timestamp_ntz")


def parse_ts(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.SSS]`` or ISO text to a naive timestamp, else NULL."""
    text = _c(text)
    spaced = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]"))
    iso = F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))
    return F.coalesce(spaced, iso).cast("timestamp_ntz")


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a naive or zoned timestamp."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def calendar(ts: str = "ts") -> dict[str, Column]:
    """hour, minute, second, weekday (Monday = 1) and the hour on a circle."""
    hour = F.hour(ts)
    return {
        "hour": hour,
        "minute": F.minute(ts),
        "second": F.second(ts),
        "weekday": F.weekday(ts) + 1,
        "hour_sin": F.sin(2 * F.pi() * hour / 24),
        "hour_cos": F.cos(2 * F.pi() * hour / 24),
    }


def book_calendar(ts: str = "ts") -> dict[str, Column]:
    """hour, dow (Monday = 0) and the hour on a circle."""
    cal = calendar(ts)
    return {
        "hour": cal["hour"],
        "dow": F.weekday(ts),
        "hour_sin": cal["hour_sin"],
        "hour_cos": cal["hour_cos"],
    }


# -- order book --------------------------------------------------------------------


def book_features(eps: float = EPS_BOOK) -> dict[str, Column]:
    """Mid, spread, imbalance, microprice and volume columns of an L1 book with
    bid_px, ask_px, bid_qty, ask_qty, vol_base."""
    bid, ask = F.col("bid_px"), F.col("ask_px")
    bq, aq, vol = F.col("bid_qty"), F.col("ask_qty"), F.col("vol_base")
    mid, spread, depth = (bid + ask) / 2, ask - bid, bq + aq + eps
    micro = div(ask * bq + bid * aq, depth)
    return {
        "mid": mid,
        "log_mid": ln(mid),
        "spread": spread,
        "rel_spread": div(spread, mid + eps),
        "imb": div(bq - aq, depth),
        "microprice": micro,
        "micro_mid_dev": div(micro - mid, mid + eps),
        "vol_log1p": F.when(vol > -1, F.log1p(vol)),
        "notional": vol * mid,
        "notional_log1p": F.when(vol * mid > -1, F.log1p(vol * mid)),
    }


def snapshot_features() -> dict[str, Column]:
    """mid_price, spread, spread_bps and book_imbalance of a snapshot with
    bid_price, ask_price, bid_qty, ask_qty."""
    bid, ask = F.col("bid_price"), F.col("ask_price")
    bq, aq = F.col("bid_qty"), F.col("ask_qty")
    mid = (bid + ask) / 2
    return {
        "mid_price": mid,
        "spread": ask - bid,
        "spread_bps": div(ask - bid, mid) * 10000,
        "book_imbalance": div(bq - aq, bq + aq),
    }


# -- live ticks ----------------------------------------------------------------------


def normalise_ticks(df: DataFrame) -> DataFrame:
    """Bring a raw message frame to ``symbol?, timestamp, timestamp_dt, price, qty,
    trade_direction``. Three shapes are told apart by their columns: book snapshots
    (bid_price, ask_price), trades (T, p, q, m) and the ``t`` variant."""
    cols = set(df.columns)
    if "bid_price" in cols:
        return df.withColumns(
            {
                "timestamp_dt": epoch_to_ts("timestamp"),
                "price": (F.col("bid_price") + F.col("ask_price")) / 2,
                "qty": (F.col("bid_qty") + F.col("ask_qty")) / 2,
                "spread": F.col("ask_price") - F.col("bid_price"),
                "trade_direction": F.lit(1),
            }
        )
    # Dots and case matter here: T (trade time) and t (trade id or time) differ.
    times = [c for c in ("timestamp", "T", "t") if c in cols]
    if not times or not cols & {"price", "p"}:
        raise ValueError(f"no time or price column in {df.columns}")
    stamp = F.col(times[0]).cast("bigint")
    price = F.col("price") if "price" in cols else to_double("p")
    if "qty" in cols:
        qty = F.col("qty")
    else:
        qty = to_double("q") if "q" in cols else F.lit(1.0)
    side = F.when(F.col("m"), -1).otherwise(1) if "m" in cols else F.lit(1)
    return df.withColumns(
        {
            "timestamp": stamp,
            "timestamp_dt": epoch_to_ts(stamp),
            "price": price,
            "qty": qty,
            "trade_direction": side,
        }
    )


def tick_columns() -> dict[str, Column]:
    """Row-wise tick columns."""
    return {
        "log_price": ln("price"),
        "dollar_volume": F.col("price") * F.col("qty"),
        "processed_at": F.current_timestamp(),
    }


# -- bars ----------------------------------------------------------------------------


def flow_columns() -> dict[str, Column]:
    """Net flow, imbalances, range and log return of a trade-flow bar."""
    bv, sv = F.col("buy_volume"), F.col("sell_volume")
    bt, st = F.col("buy_trades"), F.col("sell_trades")
    return {
        "net_volume": bv - sv,
        "volume_imbalance": div(bv - sv, bv + sv + EPS_BARS),
        "trade_imbalance": div(bt - st, bt + st + EPS_BARS),
        "price_range": F.col("high") - F.col("low"),
        "log_return": ln(div("close", "open")),
    }


def advanced_columns() -> dict[str, Column]:
    """Range, trade size, signed volume, efficiency and intensity of a flow bar."""
    n, vol, close = F.col("num_trades"), F.col("volume"), F.col("close")
    buy_size = div("buy_volume", F.col("buy_trades") + EPS_BARS)
    sell_size = div("sell_volume", F.col("sell_trades") + EPS_BARS)
    return {
        "rel_range": div(F.col("high") - F.col("low"), close),
        "avg_trade_size": div(vol, n + EPS_BARS),
        "buy_sell_size_ratio": div(buy_size, sell_size + EPS_BARS),
        "signed_volume": F.col("net_volume") * F.signum("log_return"),
        "price_efficiency": div(close - F.col("vwap"), close),
        "trade_intensity": div(n, vol + EPS_BARS),
    }


def update_columns() -> dict[str, Column]:
    """fill_ratio and delta_open of a bucket of strategy updates."""
    filled, rest = F.col("sum_filled_qty"), F.col("sum_remaining_qty")
    return {
        "fill_ratio": div(filled, filled + rest + EPS_LOGS),
        "delta_open": F.col("sum_new_open_qty") - F.col("sum_open_qty"),
    }


# -- columns of a frame -----------------------------------------------------------------


def prefixed(df: DataFrame, prefix: str, keep: Iterable[str] = ("ts", "symbol")) -> DataFrame:
    keep = set(keep)
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep})


def suffixed(df: DataFrame, suffix: str, keep: Iterable[str] = ("ts", "symbol")) -> DataFrame:
    keep = set(keep)
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c not in keep})


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of numeric columns, minus an exclude list."""
    exclude = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def float_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    exclude = set(exclude)
    kinds = (T.DoubleType, T.FloatType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in exclude]


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL and NaN of the numeric columns become 0."""
    floats = set(float_columns(df))
    changes = {}
    for c in columns or numeric_columns(df):
        value = F.nanvl(F.col(c), F.lit(0.0)) if c in floats else F.col(c)
        changes[c] = F.coalesce(value, F.lit(0).cast(df.schema[c].dataType))
    return df.withColumns(changes)


def columns_like(names: Iterable[str], *parts: str) -> list[str]:
    """Names holding any of the given parts, in order, ignoring case."""
    return [n for n in names if any(p in n.lower() for p in parts)]


# Name parts that mark price and volume columns.
PRICE_PARTS = ("price", "mid", "close", "open")
VOLUME_PARTS = ("volume", "qty", "fill")
# Columns already derived by a lag or rolling step.
DERIVED = re.compile(r"_(lag|ma|std)\d+$")


def base_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Existing columns, once each, that no lag or rolling step produced."""
    have = set(df.columns)
    return [c for c in dict.fromkeys(columns) if c in have and not DERIVED.search(c)]


# Name parts that mark the source of a feature, first match wins.
SOURCE_PARTS = {
    "signals": ("signal", "strategy", "entry"),
    "fills": ("fill", "volume", "buy", "sell"),
    "order book": ("bid", "ask", "spread", "book"),
}


def feature_source(name: Column | str, public_prefix: str = "public_") -> Column:
    """Bucket a feature name by the source it comes from."""
    name = _c(name)
    out = F.when(name.startswith(public_prefix), "public trades")
    for source, parts in SOURCE_PARTS.items():
        out = out.when(name.rlike("|".join(parts)), source)
    return out.otherwise("other")
