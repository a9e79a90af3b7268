"""Compositions from raw inputs to split, scaled and scored datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickspark.functions.expr import (
    advanced_columns,
    book_calendar,
    book_features,
    calendar,
    fill_zero,
    numeric_columns,
    prefixed,
)
from tickspark.operators import explore, quality
from tickspark.operators.align import asof_chain, cross_asset, left_matrix, span_grid, symbol_stats, time_ranges
from tickspark.operators.bars import (
    book_bars,
    fill_bars,
    fill_buckets,
    fill_volume_by,
    fill_volume_by_interval,
    flow_bars,
    signal_bars,
    strategy_buckets,
)
from tickspark.operators.labels import (
    DEADZONE_BPS,
    HORIZONS,
    create_labels,
    direction_columns,
    execution_labels,
    price_move_labels,
    return_columns,
    training_labels,
    with_book_labels,
)
from tickspark.operators.models import Fitted, fit
from tickspark.operators.ordered import Ordered
from tickspark.operators.scaling import Scaler, fit_scaler, fit_transform
from tickspark.operators.splits import EMBARGO, TRAIN, VAL, split_hash, split_rows, split_segments, split_three, split_time
from tickspark.operators.windows import (
    WINDOWS,
    engineered,
    forward_fill,
    rolling_flow,
    sequences,
    with_book_rolling,
    with_flow_rolling,
)
from tickspark.session import stage
from tickspark.sources.sinks import write_json, write_splits

# Columns of the bar tables that count events of their own bar.
COUNTS = (
    "tick_count",
    "n_signals",
    "n_entries_allowed",
    "n_fills",
    "n_buys",
    "n_sells",
    "n_orders",
    "fill_volume",
)


# -- public trades ----------------------------------------------------------------------


def trade_features(
    trades: DataFrame,
    every: str = "1s",
    windows: Sequence[int] = WINDOWS,
    horizons: Sequence[int] = HORIZONS,
    deadzone_bps: float = DEADZONE_BPS,
    *,
    advanced: bool = False,
    order: Sequence[str] = ("ts", "trade_id"),
) -> DataFrame:
    """Trades to flow bars with rolling features and return and direction labels.
    All of them share one shuffle and one sort of the bars."""
    bars = flow_bars(trades, every, order=order)
    if advanced:
        bars = bars.withColumns(advanced_columns())

    def add(df: DataFrame, w: WindowSpec) -> DataFrame:
        # Leads first: rolling features end the work on the sorted series.
        return with_flow_rolling(df.withColumns(return_columns(w, horizons)), w, windows, advanced)

    rows = Ordered(bars, ["symbol"], ["ts"], at_most=trades)
    made = rows.windows(add, back=2 * max(windows), forward=max(horizons))
    return made.withColumns(direction_columns(horizons, deadzone_bps))


def trade_dataset(
    trades: DataFrame,
    path: str,
    every: str = "1s",
    windows: Sequence[int] = WINDOWS,
    horizons: Sequence[int] = HORIZONS,
    deadzone_bps: float = DEADZONE_BPS,
    *,
    train: float = TRAIN,
    val: float = VAL,
    embargo: int = EMBARGO,
    target: str | None = None,
    order: Sequence[str] = ("ts", "trade_id"),
) -> dict:
    """Trades to a written train/val/test dataset. With ``target`` the other symbols'
    features are joined to that symbol by time. Returns the metadata."""
    made = stage(trade_features(trades, every, windows, horizons, deadzone_bps, order=order))
    if target is not None:
        # One row per symbol.
        others = [r[0] for r in made.select("symbol").distinct().collect() if r[0] != target]
        made = stage(cross_asset(made, target, sorted(others)))
    labels = [c for c in made.columns if c.startswith("y_")]
    parts = split_rows(made.dropna(subset=labels), train, val, embargo)
    return write_splits(parts, path, extra={"interval": every})


@dataclass(frozen=True)
class Dataset:
    """A split frame with the names of its features and label."""

    df: DataFrame
    features: tuple[str, ...]
    label: str
    scaler: Scaler | None = None

    def part(self, split: str) -> DataFrame:
        return self.df.where(F.col("split") == split)

    def summary(self) -> DataFrame:
        return explore.dataset_summary(self.df, self.features, self.label)


def trade_training_set(
    trades: DataFrame,
    every: str = "1s",
    horizon: int = 30,
    deadzone_bps: float = DEADZONE_BPS,
    windows: Sequence[int] = WINDOWS,
    *,
    advanced: bool = True,
    val: float = 0.2,
    test: float = 0.0,
    embargo: int = EMBARGO,
    order: Sequence[str] = ("ts", "trade_id"),
) -> Dataset:
    """Trades to features with gaps filled by 0, one direction label, numeric
    feature selection and a two- or three-way split per symbol."""
    made = trade_features(trades, every, windows, [horizon], deadzone_bps, advanced=advanced, order=order)
    label = f"y_dir_{horizon}"
    features = numeric_columns(made, [c for c in made.columns if c.startswith("y_")])
    ready = fill_zero(stage(made.where(F.col(label).isNotNull())), features)
    if test > 0:
        parts = split_three(ready, val, test, embargo)
    else:
        parts = split_time(ready, val, by=["symbol"])
    return Dataset(parts, tuple(features), label)


# -- order book ----------------------------------------------------------------------------


def book_dataset(
    book: DataFrame,
    path: str | None = None,
    *,
    expected: str = "1s",
    gap_policy: str = "segment",
    min_segment: int = 600,
    windows: Sequence[int] = WINDOWS,
    horizons: Sequence[int] = HORIZONS,
    deadzone: str = "half_spread",
    fixed_bps: float = 1.0,
    train: float = TRAIN,
    val: float = VAL,
    embargo_s: float = EMBARGO,
    scaling: str = "standard",
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = (),
) -> Dataset:
    """L1 book to validated, segmented, labelled, split and scaled rows. With a path
    the data, validation report, names, sizes and scaler are written below it. ``order``:
    columns that put rows of equal time in order in labels, windows and the split; like ``by``
    they are no features."""
    clean = quality.clean_book(book)
    parts = quality.add_segments(clean, expected, gap_policy, by=by)
    parts = quality.drop_short_segments(parts, min_segment, by=by)
    parts = parts.withColumns(book_features())

    def add(df: DataFrame, w: WindowSpec) -> DataFrame:
        df = df.withColumn("r1", F.col("log_mid") - F.lag("log_mid").over(w))
        return with_book_rolling(with_book_labels(df, w, horizons, deadzone, fixed_bps), w, windows)

    rows = Ordered(parts, by, ["ts", *order]).windows(
        add, back=max(windows) + 1, forward=max(horizons), within=["segment_id"]
    )
    rows = rows.withColumns(book_calendar())
    labels = [c for c in rows.columns if c.startswith("y_")]
    features = numeric_columns(rows, [*labels, "ts_ms", "segment_id", *by, *order])
    usable = stage(rows.dropna(subset=[*features, *labels]))
    split = split_segments(usable, train, val, embargo_s, by=by, order=order)
    scaler = None
    if scaling != "none":
        split = stage(split)
        split, scaler = fit_transform(split, features, scaling)
    if path is not None:
        spark = book.sparkSession
        write_splits(split, path, extra={"labels": labels, "features": features})
        report = quality.book_report(book, expected=expected, by=by).first().asDict()
        write_json(spark, f"{path}/validation_report", report)
        if scaler:
            scaler.save(spark, f"{path}/scaler")
    return Dataset(split, tuple(features), f"y_dir_{horizons[0]}", scaler)


# -- several sources ---------------------------------------------------------------------


def unified(
    every: str = "1s",
    *,
    snapshots: DataFrame | None = None,
    signals: DataFrame | None = None,
    fills: DataFrame | None = None,
    public_trades: DataFrame | None = None,
    overlap_only: bool = True,
    windows: Sequence[int] = (5, 15, 60),
    public_prefix: str = "public_",
    carry_counts: bool = False,
    orders: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """All sources on one time grid per symbol: bars of each source, aligned by an
    as-of chain, with time features, gaps as 0. Time columns are called
    ``timestamp`` but for public trades, which use ``ts``. ``orders`` may name the
    tick order of each source."""
    orders = {"public": ("ts", "trade_id"), **(orders or {})}
    at = ("timestamp",)
    bars: dict[str, DataFrame] = {}
    if snapshots is not None:
        bars["store"] = book_bars(snapshots, every, order=orders.get("store", at))
    if signals is not None:
        bars["signals"] = signal_bars(signals, every, order=orders.get("signals", at))
    if fills is not None:
        bars["fills"] = fill_bars(fills, every, order=orders.get("fills", at))
    if public_trades is not None:
        flow = rolling_flow(flow_bars(public_trades, every, order=orders["public"]), windows, advanced=True)
        bars["public"] = prefixed(flow, public_prefix).withColumnRenamed("ts", "timestamp")
    spans = [s for s in (snapshots, signals) if s is not None]
    common = overlap_only and len(spans) == 2
    if not common:
        spans = [s for s in (snapshots, signals, fills) if s is not None]
        spans = spans or [public_trades.withColumnRenamed("ts", "timestamp")]
    grid = span_grid(spans, every, ts="timestamp", common=common)
    rows = asof_chain(grid, bars, on="timestamp", counts=COUNTS, carry_counts=carry_counts)
    return fill_zero(rows.withColumns(calendar("timestamp")))


# Columns that are kept in a unified dataset but are not features.
NOT_FEATURES = ("timestamp", "timestamp_ms", "symbol", "label", "hour", "minute", "second", "weekday")


def unified_training_set(
    rows: DataFrame,
    kind: str = "fill_occurred",
    horizon: int = 30,
    *,
    lags: Sequence[int] = (1, 5, 10, 30),
    windows: Sequence[int] = (5, 10, 30, 60),
    val: float = 0.2,
    by_time: bool = True,
) -> Dataset:
    """Unified rows to labels, lag and rolling features and a train/val split per
    symbol, in time or by hash of the row key."""
    by, order = ["symbol"], ["timestamp"]
    labelled = create_labels(stage(rows), kind, horizon, by=by, order=order)
    made = engineered(labelled, lags=lags, windows=windows, by=by, order=order)
    made = stage(made.where(F.col("label").isNotNull()))
    features = numeric_columns(made, NOT_FEATURES)
    if by_time:
        parts = split_time(made, val, by=by, order=order)
    else:
        parts = split_hash(made, [*by, *order], val)
    return Dataset(parts, tuple(features), "label")


# -- strategy logs ------------------------------------------------------------------------


def log_matrix(updates: DataFrame, fills: DataFrame, every: str = "1s", *, fill: bool, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Strategy updates and fills on a per-symbol grid; ``fill`` carries every value
    forward, otherwise gaps are 0."""
    strat = strategy_buckets(updates, every)
    done = fill_buckets(fills, every, order=order)
    matrix = left_matrix(span_grid([strat, done], every), strat, done)
    return forward_fill(matrix) if fill else fill_zero(matrix)


def price_move_set(
    updates: DataFrame,
    fills: DataFrame,
    every: str = "1s",
    horizon: int = 5,
    deadband: float = 5e-4,
    *,
    val: float = 0.2,
    limit_rows: int | None = None,
    order: Sequence[str] = ("ts",),
) -> Dataset:
    """Price-move dataset on the last fill price, with ``mid``, ``future_mid``,
    ``ret_h`` and the class ``y``."""
    rows = log_matrix(updates, fills, every, fill=True, order=order)
    rows = stage(rows.where(F.col("last_fill_price").isNotNull()))
    made = price_move_labels(rows, horizon, deadband)
    made = made.withColumnsRenamed({"future_price": "future_mid", "future_return": "ret_h", "price_move_cls": "y"})
    made = made.withColumn("mid", F.col("last_fill_price")).where(F.col("y").isNotNull())
    made = fill_zero(made)
    if limit_rows is not None:
        made = made.orderBy("symbol", "ts").limit(limit_rows)
    features = numeric_columns(made, ["future_mid", "ret_h", "y"])
    return Dataset(split_time(made, val, order=["ts", "symbol"]), tuple(features), "y")


def execution_set(
    updates: DataFrame,
    fills: DataFrame,
    every: str = "1s",
    horizon: int = 5,
    *,
    val: float = 0.2,
    order: Sequence[str] = ("ts",),
) -> Dataset:
    """Will-fill dataset over the filled quantity of both sources."""
    rows = stage(log_matrix(updates, fills, every, fill=False, order=order))
    rows = rows.withColumn("total_fill_qty", F.col("sum_filled_qty") + F.col("sum_fill_qty"))
    made = execution_labels(rows, horizon, source="total_fill_qty").where(F.col("future_fill_sum").isNotNull())
    features = numeric_columns(made, ["future_fill_sum", "will_fill"])
    parts = split_time(made, val, order=["ts", "symbol"])
    return Dataset(parts, tuple(features), "will_fill")


# -- training -----------------------------------------------------------------------------

NOT_INPUTS = ("symbol", "timestamp", "timestamp_dt", "processed_at", "date", "hour")


def training_set(
    features_table: DataFrame,
    kind: str = "direction",
    horizon: int = 30,
    threshold: float = 1e-4,
    *,
    features: Sequence[str] | None = None,
    val: float = 0.2,
    by_time: bool = True,
    scaling: str = "standard",
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("timestamp",),
) -> Dataset:
    """A feature table to a labelled, split and scaled dataset."""
    made = training_labels(features_table, kind, horizon, threshold, by=by, order=order)
    names = list(features) if features else numeric_columns(made, [*NOT_INPUTS, "label", *by, *order])
    names = [c for c in names if c in made.columns]
    rows = stage(made.dropna(subset=["label", *names]))
    if by_time:
        parts = split_time(rows, val, by=by, order=order)
    else:
        parts = split_hash(rows, [*by, *order], val)
    if scaling == "none":
        return Dataset(parts, tuple(names), "label")
    scaler = fit_scaler(parts.where(F.col("split") == "train"), names, scaling)
    return Dataset(scaler.transform(parts), tuple(names), "label", scaler)


def training_sequences(data: Dataset, split: str, length: int = 60, *, by: Sequence[str] = ("symbol",), order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Sequences of one split; they never reach into another."""
    return sequences(data.part(split), data.features, data.label, length=length, by=by, order=order)


def experiment(data: Dataset, kind: str = "logistic", **params: float) -> tuple[Fitted, DataFrame]:
    """Fit on train; (model, one row of validation metrics and sizes)."""
    train, held = data.part("train"), data.part("val")
    model = fit(train, data.features, data.label, kind, **params)
    sizes = data.df.groupBy().agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "val").alias("n_val")
    ).first()
    metrics = model.evaluate(held).withColumns(
        {"n_train": F.lit(sizes["n_train"]), "n_val": F.lit(sizes["n_val"]), "n_features": F.lit(len(data.features))}
    )
    return model, metrics


# -- reports ------------------------------------------------------------------------------


def split_reports(
    train: DataFrame,
    val: DataFrame,
    test: DataFrame,
    *,
    returns: Sequence[str] = ("y_ret_5", "y_ret_30", "y_ret_60"),
    directions: Sequence[str] = ("y_dir_5", "y_dir_30", "y_dir_60"),
    volatilities: Sequence[str] = ("y_vol_5", "y_vol_30", "y_vol_60"),
    rules: quality.QualityRules = quality.QualityRules(),
) -> dict[str, DataFrame]:
    """Quality, comparison and target tables over three splits."""
    parts = {"train": train, "val": val, "test": test}

    def have(names: Sequence[str]) -> list[str]:
        return [n for n in names if n in train.columns]

    checks = [quality.quality_report(df, rules).withColumn("split", F.lit(n)) for n, df in parts.items()]
    targets = [
        explore.target_report(df, have(returns), have(directions), have(volatilities)).withColumn("split", F.lit(n))
        for n, df in parts.items()
    ]
    return {
        "quality": checks[0].unionByName(checks[1]).unionByName(checks[2]),
        "compare": quality.compare_splits(train, val, test, rules.ts),
        "targets": targets[0].unionByName(targets[1]).unionByName(targets[2]),
    }


def log_summary(signals: DataFrame, fills: DataFrame, labelled: DataFrame) -> dict[str, DataFrame]:
    """Tables about signals, fills and how often a fill follows a signal."""
    return {
        "symbols": symbol_stats(signals, fills),
        "ranges": time_ranges({"signals": signals, "fills": fills}),
        "by_strategy": explore.signal_counts(signals, "strategy_id", "signal_value"),
        "fill_rate_symbol": explore.fill_rate(labelled, "symbol"),
        "fill_rate_signal": explore.fill_rate(labelled, "signal_value"),
        "volume": fill_volume_by_interval(fills),
        "volume_symbol": fill_volume_by(fills, "symbol"),
        "volume_side": fill_volume_by(fills, "side"),
    }


def trade_summary(bars: DataFrame) -> dict[str, DataFrame]:
    """Tables about public-trade bars."""
    columns = ["volume", "num_trades", "volume_imbalance", "trade_imbalance", "log_return"]
    return {
        "symbols": explore.symbol_summary(bars),
        "hourly": explore.hourly_return(bars),
        "profile": explore.profile(bars, columns),
        "correlation": explore.pearson(bars, columns),
    }


def unified_summary(rows: DataFrame, label: str = "label") -> dict[str, DataFrame]:
    """Tables about a unified dataset."""
    sources = {
        "order book": ("bid_price", "ask_price", "avg_spread", "tick_count"),
        "signals": ("last_signal", "n_signals", "n_strategies"),
        "fills": ("fill_volume", "n_fills", "last_fill_price"),
    }
    out = {"sources": quality.source_availability(rows, sources)}
    if label in rows.columns:
        out["classes"] = explore.class_share(rows, label)
    if {"last_signal", "fill_volume"} <= set(rows.columns):
        out["fills_by_signal"] = explore.fill_volume_by_signal(rows)
    return out
