"""Forward-looking labels. A label is NULL where its horizon runs past the end of
the series, and never looks across a symbol or segment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickspark.functions.expr import div, ln
from tickspark.operators.ordered import Ordered

# Default horizons in rows, dead zone in basis points.
HORIZONS = (5, 30, 60)
DEADZONE_BPS = 5.0


def three_way(value: Column, threshold: Column | float, up: int = 1, flat: int = 0, down: int = -1) -> Column:
    """up / flat / down by a dead zone; NULL stays NULL."""
    return (
        F.when(value.isNull(), F.lit(None).cast("int"))
        .when(value > threshold, up)
        .when(value < -threshold, down)
        .otherwise(flat)
    )


def ahead_sum(value: Column | str, spec: WindowSpec, horizon: int) -> Column:
    """Sum of the next ``horizon`` values, NULL unless all exist."""
    value = F.col(value) if isinstance(value, str) else value
    frame = spec.rowsBetween(1, horizon)
    return F.when(F.count(value).over(frame) >= horizon, F.sum(value).over(frame))


# -- column builders ------------------------------------------------------------------


def return_columns(spec: WindowSpec, horizons: Sequence[int] = HORIZONS, price: str = "close") -> dict[str, Column]:
    return {f"y_ret_{h}": ln(div(F.lead(price, h).over(spec), price)) for h in horizons}


def direction_columns(horizons: Sequence[int] = HORIZONS, deadzone_bps: float = DEADZONE_BPS) -> dict[str, Column]:
    """Needs the y_ret columns."""
    return {f"y_dir_{h}": three_way(F.col(f"y_ret_{h}"), F.lit(deadzone_bps * 1e-4)) for h in horizons}


def volatility_columns(spec: WindowSpec, horizons: Sequence[int] = HORIZONS, ret: str = "log_return") -> dict[str, Column]:
    squared = F.col(ret) * F.col(ret)
    return {f"y_vol_{h}": F.sqrt(ahead_sum(squared, spec, h)) for h in horizons}


def with_book_labels(
    df: DataFrame,
    spec: WindowSpec,
    horizons: Sequence[int] = HORIZONS,
    deadzone: str = "half_spread",
    fixed_bps: float = 1.0,
) -> DataFrame:
    """Return, direction and volatility of the log mid over mid, log_mid, spread, r1."""
    if deadzone == "half_spread":
        zone = ln(div(F.col("mid") + F.col("spread") / 2, "mid"))
    elif deadzone == "fixed_bps":
        zone = F.lit(fixed_bps * 1e-4)
    else:
        raise ValueError(f"unknown dead zone: {deadzone}")
    df = df.withColumns({f"y_ret_{h}": F.lead("log_mid", h).over(spec) - F.col("log_mid") for h in horizons})
    out = {f"y_dir_{h}": three_way(F.col(f"y_ret_{h}"), zone) for h in horizons}
    return df.withColumns(out | volatility_columns(spec, horizons, "r1"))


# -- operators ----------------------------------------------------------------------------


def _labelled(
    df: DataFrame,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    horizon: int,
    by: Sequence[str],
    order: Sequence[str],
    within: Sequence[str] = (),
) -> DataFrame:
    return Ordered(df, by, order).windows(add, forward=horizon, within=within)


def add_return_labels(
    bars: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    *,
    price: str = "close",
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Log return to the close ``h`` bars ahead."""
    return _labelled(bars, lambda d, w: d.withColumns(return_columns(w, horizons, price)), max(horizons), by, order)


def add_direction_labels(
    bars: DataFrame, horizons: Sequence[int] = HORIZONS, deadzone_bps: float = DEADZONE_BPS
) -> DataFrame:
    """-1 / 0 / +1 of existing return labels."""
    return bars.withColumns(direction_columns(horizons, deadzone_bps))


def add_volatility_labels(
    bars: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    *,
    ret: str = "log_return",
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
    within: Sequence[str] = (),
) -> DataFrame:
    """Root of the summed squared returns of the next ``h`` rows."""
    return _labelled(
        bars, lambda d, w: d.withColumns(volatility_columns(w, horizons, ret)), max(horizons), by, order, within
    )


def add_book_labels(
    book: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    deadzone: str = "half_spread",
    fixed_bps: float = 1.0,
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Book labels per segment."""
    return _labelled(
        book,
        lambda d, w: with_book_labels(d, w, horizons, deadzone, fixed_bps),
        max(horizons),
        by,
        order,
        ["segment_id"],
    )


def price_move_labels(
    df: DataFrame,
    horizon: int = 5,
    deadband: float = 5e-4,
    *,
    price: str = "last_fill_price",
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """future_price, future_return and price_move_cls."""

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = d.withColumn("future_price", F.lead(price, horizon).over(w))
        d = d.withColumn("future_return", div(F.col("future_price") - F.col(price), price))
        return d.withColumn("price_move_cls", three_way(F.col("future_return"), F.lit(deadband)))

    return _labelled(df, add, horizon, by, order)


def execution_labels(
    df: DataFrame,
    horizon: int = 5,
    *,
    source: str = "sum_filled_qty",
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """future_fill_sum and will_fill over the next ``horizon`` rows."""

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = d.withColumn("future_fill_sum", ahead_sum(source, w, horizon))
        return d.withColumn("will_fill", (F.col("future_fill_sum") > 0).cast("int"))

    return _labelled(df, add, horizon, by, order)


def create_labels(
    df: DataFrame,
    kind: str = "fill_occurred",
    horizon: int = 30,
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """``label`` of a unified frame: "fill_occurred" (a fill in the next rows),
    "price_direction" (a higher price ``horizon`` rows ahead) or "auto"."""
    return _labelled(df, lambda d, w: d.withColumn("label", unified_label(d, w, kind, horizon)), horizon, by, order)


def unified_label(df: DataFrame, spec: WindowSpec, kind: str, horizon: int) -> Column:
    fill = next((c for c in ("n_fills", "fill_volume") if c in df.columns), None)
    price = next((c for c in ("close", "mid_price", "signal_mid_price") if c in df.columns), None)
    if kind not in ("auto", "fill_occurred", "price_direction"):
        raise ValueError(f"unknown label type: {kind}")
    if kind != "price_direction" and fill:
        return (ahead_sum(fill, spec, horizon) > 0).cast("int")
    if price is None:
        raise ValueError("no column to make a label from")
    return (F.lead(price, horizon).over(spec) > F.col(price)).cast("int")


def training_labels(
    df: DataFrame,
    kind: str = "direction",
    horizon: int = 30,
    threshold: float = 1e-4,
    *,
    price: str = "price",
    ret: str = "return_1",
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """``label`` for model training: "direction" (0/1), "direction_3" (0 down, 1 flat,
    2 up), "regression" (simple return) or "volatility" (std of the next returns)."""

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        move = div(F.lead(price, horizon).over(w), price) - 1
        if kind == "direction":
            return d.withColumn("label", (move > threshold).cast("int"))
        if kind == "direction_3":
            return d.withColumn("label", three_way(move, F.lit(threshold), 2, 1, 0))
        if kind == "regression":
            return d.withColumn("label", move)
        if kind == "volatility":
            frame = w.rowsBetween(1, horizon)
            full = F.count(ret).over(frame) >= horizon
            return d.withColumn("label", F.when(full, F.stddev_samp(ret).over(frame)))
        raise ValueError(f"unknown label type: {kind}")

    return _labelled(df, add, horizon, by, order)


def next_up_label(
    df: DataFrame,
    *,
    ret: str = "return_1",
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """``target``: whether the next return is positive."""
    return _labelled(df, lambda d, w: d.withColumn("target", (F.lead(ret).over(w) > 0).cast("int")), 1, by, order)


def horizon_label(
    df: DataFrame,
    kind: str = "direction",
    horizon: int = 30,
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """Up label or simple return at a horizon on the mid or price; the last rows of
    each series, whose future is unknown, are cut."""
    price = next(c for c in ("mid_price", "mid", "price", "close") if c in df.columns)

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        later = F.lead(price, horizon).over(w)
        made = (later > F.col(price)).cast("int") if kind == "direction" else div(later, price) - 1
        return d.withColumn("label", made)

    return _labelled(df, add, horizon, by, order).where(F.col("label").isNotNull())
