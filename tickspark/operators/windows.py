"""Rolling, lag and fill features. The ``with_*`` functions add features for one
window spec, so every feature of a series is computed on one shared sort; the other
functions run them through ``Ordered``.

Rolling values follow the two conventions of the domain: trade bars have a value
only where the window holds ``w`` non-NULL values, books and ticks accept any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickspark.functions.expr import (
    EPS_BARS,
    PRICE_PARTS,
    VOLUME_PARTS,
    advanced_columns,
    base_columns,
    columns_like,
    div,
    fill_zero,
    float_columns,
    micros,
    numeric_columns,
    tick_columns,
)
from tickspark.operators.ordered import Ordered
from tickspark.operators.rolling import Rolling

# Default windows (bars, book, live ticks) and lags.
WINDOWS = (5, 15, 60, 300)
TICK_WINDOWS = (5, 10, 30)
FLOW_WINDOWS = (10, 30)
TICK_LAGS = (1, 5, 10)


def flow_rolling(r: Rolling, windows: Sequence[int]) -> dict[str, Column]:
    out = {}
    for w in windows:
        out[f"vol_sum_{w}"] = r.sum("volume", w)
        out[f"vol_imb_mean_{w}"] = r.avg("volume_imbalance", w)
        out[f"trade_imb_mean_{w}"] = r.avg("trade_imbalance", w)
        out[f"ret_std_{w}"] = r.std("log_return", w)
        out[f"net_vol_sum_{w}"] = r.sum("net_volume", w)
        out[f"vwap_dev_{w}"] = div(F.col("close") - r.avg("vwap", w), "close")
    return out


def advanced_rolling(r: Rolling, windows: Sequence[int]) -> dict[str, Column]:
    """Needs the columns of ``advanced_columns`` and ``__cross``; windows reach back
    twice the largest."""
    out = {}
    for w in windows:
        moved = r.sum("log_return", w)
        out[f"toxicity_{w}"] = r.avg(F.abs("volume_imbalance"), w)
        out[f"imb_volatility_{w}"] = r.std("volume_imbalance", w)
        out[f"trade_rate_{w}"] = r.avg("num_trades", w)
        out[f"vol_accel_{w}"] = r.avg("volume", w) - r.avg("volume", w, back=w)
        out[f"trade_size_ratio_{w}"] = div("avg_trade_size", r.avg("avg_trade_size", w) + EPS_BARS)
        out[f"momentum_{w}"] = moved
        out[f"ret_autocorr_{w}"] = r.avg("__cross", w)
        out[f"kyle_lambda_{w}"] = r.sum("signed_volume", w)
        out[f"price_impact_{w}"] = div(moved, r.sum("volume", w) + EPS_BARS)
        out[f"vwap_tracking_{w}"] = r.avg(F.abs("price_efficiency"), w)
        out[f"range_ratio_{w}"] = div("rel_range", r.avg("rel_range", w) + EPS_BARS)
        slower = r.avg("trade_intensity", 2 * w) + EPS_BARS
        out[f"intensity_momentum_{w}"] = div(r.avg("trade_intensity", w), slower)
    return out


def with_flow_rolling(df: DataFrame, spec: WindowSpec, windows: Sequence[int] = WINDOWS, advanced: bool = False) -> DataFrame:
    r = Rolling(spec)
    made = flow_rolling(r, windows)
    if advanced:
        made |= advanced_rolling(r, windows)
        df = df.withColumn("__cross", F.col("log_return") * F.lag("log_return").over(spec))
    return r.detach(r.attach(df).withColumns(made)).drop("__cross")


def kyle_lambda_ols(spec: WindowSpec, windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    """Slope of log return on signed volume over full windows."""
    out = {}
    for w in windows:
        frame = spec.rowsBetween(1 - w, 0)
        both = F.when(F.col("signed_volume").isNotNull() & F.col("log_return").isNotNull(), 1)
        slope = F.regr_slope("log_return", "signed_volume").over(frame)
        out[f"kyle_lambda_ols_{w}"] = F.when(F.count(both).over(frame) >= w, slope)
    return out


def rolling_flow(
    bars: DataFrame,
    windows: Sequence[int] = WINDOWS,
    *,
    by: Sequence[str] = ("symbol",),
    ts: str = "ts",
    advanced: bool = False,
    trades: DataFrame | None = None,
) -> DataFrame:
    """Rolling order-flow features of flow bars; ``advanced`` adds the second set.
    With the ``trades`` behind the bars, small inputs skip counting the bars."""
    if advanced:
        bars = bars.withColumns(advanced_columns())
    return Ordered(bars, by, [ts], at_most=trades).windows(
        lambda d, w: with_flow_rolling(d, w, windows, advanced), back=2 * max(windows)
    )


def with_book_rolling(df: DataFrame, spec: WindowSpec, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """r1 and rolling book features accepting any number of rows."""
    r = Rolling(spec, min_periods=1)
    made = {}
    for w in windows:
        made[f"r1_std_{w}"] = r.std("r1", w)
        made[f"vol_sum_{w}"] = r.sum("vol_base", w)
        made[f"not_sum_{w}"] = r.sum("notional", w)
        made[f"imb_mean_{w}"] = r.avg("imb", w)
        made[f"spr_mean_{w}"] = r.avg("rel_spread", w)
    df = df.withColumn("r1", F.col("log_mid") - F.lag("log_mid").over(spec))
    return r.detach(r.attach(df).withColumns(made))


def segment_rolling(
    book: DataFrame,
    windows: Sequence[int] = WINDOWS,
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """r1 and rolling book features that never cross a segment."""
    return Ordered(book, by, order).windows(
        lambda d, w: with_book_rolling(d, w, windows), back=max(windows) + 1, within=["segment_id"]
    )


def add_lags(
    df: DataFrame,
    columns: Sequence[str],
    lags: Sequence[int],
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """``{col}_lag{k}`` for every base column."""
    names = base_columns(df, columns)
    return Ordered(df, by, order).windows(
        lambda d, w: d.withColumns(lag_columns(d, w, names, lags)), back=max(lags)
    )


def lag_columns(df: DataFrame, spec: WindowSpec, columns: Sequence[str], lags: Sequence[int]) -> dict[str, Column]:
    made = {f"{c}_lag{k}": F.lag(c, k).over(spec) for c in columns for k in lags}
    return {n: c for n, c in made.items() if n not in df.columns}


def add_rolling(
    df: DataFrame,
    columns: Sequence[str],
    windows: Sequence[int],
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """``{col}_ma{w}`` and ``{col}_std{w}`` for every base column."""
    names = base_columns(df, columns)
    return Ordered(df, by, order).windows(
        lambda d, w: with_mean_std(d, w, names, windows), back=max(windows)
    )


def with_mean_std(df: DataFrame, spec: WindowSpec, columns: Sequence[str], windows: Sequence[int]) -> DataFrame:
    r = Rolling(spec)
    made = {}
    for c in columns:
        for w in windows:
            if f"{c}_ma{w}" not in df.columns:
                made[f"{c}_ma{w}"] = r.avg(c, w)
            if f"{c}_std{w}" not in df.columns:
                made[f"{c}_std{w}"] = r.std(c, w)
    return r.detach(r.attach(df).withColumns(made)) if made else df


def tick_statistics() -> dict[str, tuple[str, str, int]]:
    """Rolling features of live ticks: name -> (statistic, series, rows)."""
    out = {}
    for w in TICK_WINDOWS:
        out[f"price_ma_{w}"] = ("avg", "price", w)
        out[f"price_std_{w}"] = ("std", "price", w)
        out[f"volume_sum_{w}"] = ("sum", "qty", w)
        out[f"return_ma_{w}"] = ("avg", "return_1", w)
    out.update({f"order_flow_{w}": ("sum", "flow", w) for w in FLOW_WINDOWS})
    return out


def with_tick_rolling(df: DataFrame, spec: WindowSpec) -> DataFrame:
    """Return, rolling and lag features of live ticks."""
    r = Rolling(spec, min_periods=1)
    flow = F.col("trade_direction") * F.col("qty")
    made = {}
    for name, (stat, series, w) in tick_statistics().items():
        made[name] = getattr(r, stat)(flow if series == "flow" else series, w)
    df = df.withColumn("return_1", div("price", F.lag("price").over(spec)) - 1)
    df = df.withColumns({f"{n}_lag_{k}": F.lag(c, k).over(spec) for k in TICK_LAGS for n, c in (("price", "price"), ("return", "return_1"))})
    return r.detach(r.attach(df).withColumns(made))


def tick_features(
    ticks: DataFrame,
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("timestamp",),
    plain: bool = False,
) -> DataFrame:
    """Live tick features over ticks with price, qty and trade_direction.
    Add the file path to ``by`` to restart the state at each file."""
    by = [c for c in by if c in ticks.columns]
    reach = max(*TICK_WINDOWS, *TICK_LAGS, *FLOW_WINDOWS) + 1
    rows = Ordered(ticks, by, order, plain=plain).windows(with_tick_rolling, back=reach)
    return rows.withColumns(tick_columns())


def forward_fill(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Carry the last non-NULL value of each column forward inside its series."""
    names = columns or [c for c in df.columns if c not in {*by, *order}]
    filled = Ordered(df, by, order).last_known(**{f"__f_{c}": F.col(c) for c in names})
    return filled.drop(*names).withColumnsRenamed({f"__f_{c}": c for c in names}).select(*df.columns)


def cumulative_return(bars: DataFrame, *, by: Sequence[str] = ("symbol",), ts: str = "ts") -> DataFrame:
    """Return of each close against the first close of its series, a NULL key included."""
    own = [F.col(k).alias(f"__k{i}") for i, k in enumerate(by)]
    first = bars.groupBy(*own).agg(F.min_by("close", ts).alias("__first"))
    out = bars.join(first, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(by)])
    return out.withColumn("cum_return", div("close", "__first") - 1).select(*bars.columns, "cum_return")


def engineered(
    df: DataFrame,
    *,
    lags: Sequence[int] = (1, 5, 10, 30),
    windows: Sequence[int] = (5, 10, 30, 60),
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Lag and rolling features of the key price and volume columns, gaps as 0:
    lags of the first three price and two volume columns, rolling statistics of the
    first two price columns and one volume column. One shuffle for all of them."""
    names = float_columns(df, ["label"])
    prices, volumes = columns_like(names, *PRICE_PARTS), columns_like(names, *VOLUME_PARTS)
    lagged = base_columns(df, prices[:3] + volumes[:2])
    rolled = base_columns(df, prices[:2] + volumes[:1])

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        made = lag_columns(d, w, lagged, lags)
        return with_mean_std(d.withColumns(made) if made else d, w, rolled, windows)

    made = Ordered(df, by, order).windows(add, back=max(*lags, *windows))
    # A label without a future stays NULL.
    return fill_zero(made, numeric_columns(made, ["label"]))


def sequences(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    *,
    length: int = 60,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """For each row with ``length`` earlier rows: their feature vectors, oldest
    first, and the row's own label. The output holds ``length`` copies of the data,
    so keep only the columns and split a model needs."""
    vector = F.array(*[F.col(c).cast("double") for c in features])
    narrow = df.select(*by, *order, F.col(label), vector.alias("__x"))

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumn("sequence", F.collect_list("__x").over(w.rowsBetween(-length, -1)))

    out = Ordered(narrow, by, order).windows(add, back=length)
    return out.where(F.size("sequence") == length).drop("__x")


def gap_micros(spec: WindowSpec, ts: str = "ts") -> Column:
    """Microseconds since the previous row."""
    return micros(ts) - F.lag(micros(ts)).over(spec)
