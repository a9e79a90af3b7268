"""Validation, gap segments and data-quality reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickspark.functions.expr import interval_micros, micros, numeric_columns
from tickspark.operators.align import union_all
from tickspark.operators.ordered import Ordered
from tickspark.operators.quantiles import exact_quantiles
from tickspark.operators.windows import forward_fill, gap_micros
from tickspark.session import stage

BOOK_PRICES = ("bid_px", "ask_px")
BOOK_SIZES = ("bid_qty", "ask_qty", "vol_base")


# -- validation ---------------------------------------------------------------------


def _book_rules(drop_nonpositive: bool, enforce_uncrossed: bool, ts: str) -> dict[str, Column]:
    """Rule name -> row breaks it; the first broken rule counts."""
    needed = [*BOOK_PRICES, *BOOK_SIZES, ts]
    null = F.lit(False)
    for c in needed:
        null = null | F.col(c).isNull()
        if c != ts:
            null = null | F.isnan(F.col(c).cast("double"))
    positive = F.lit(True)
    for c in BOOK_PRICES:
        positive = positive & (F.col(c) > 0)
    for c in BOOK_SIZES:
        positive = positive & (F.col(c) >= 0)
    rules = {"dropped_null": null}
    if drop_nonpositive:
        rules["dropped_nonpositive"] = ~positive
    if enforce_uncrossed:
        rules["dropped_crossed"] = F.col("bid_px") > F.col("ask_px")
    return rules


def _broken(rules: dict[str, Column]) -> Column:
    out = F.lit(None).cast("string")
    for name, breaks in reversed(rules.items()):
        out = F.when(breaks, F.lit(name)).otherwise(out)
    return out


def clean_book(
    book: DataFrame, *, drop_nonpositive: bool = True, enforce_uncrossed: bool = True, ts: str = "ts"
) -> DataFrame:
    """Rows of an L1 book that pass every rule."""
    rules = _book_rules(drop_nonpositive, enforce_uncrossed, ts)
    return book.where(_broken(rules).isNull())


def book_report(
    book: DataFrame,
    *,
    drop_nonpositive: bool = True,
    enforce_uncrossed: bool = True,
    expected: str = "1s",
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
    plain: bool = False,
) -> DataFrame:
    """One row: total rows, rows dropped per rule (each row counts once, under the
    first rule it breaks), rows kept and gaps of unexpected length among them."""
    ts = order[0]
    rules = _book_rules(drop_nonpositive, enforce_uncrossed, ts)
    why = _broken(rules)
    counts = book.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.coalesce(why == name, F.lit(False))).alias(name) for name in rules],
        F.count_if(why.isNull()).alias("kept_rows"),
    )
    kept = book.where(why.isNull()).select(*by, *order)
    step = interval_micros(expected)
    gaps = Ordered(kept, by, order, plain=plain).windows(
        lambda d, w: d.withColumn("__gap", gap_micros(w, ts)), back=1
    )
    odd = gaps.agg(F.count_if(F.col("__gap") != step).alias("dt_anomalies"))
    return counts.withColumn("dt_anomalies", odd.scalar())


# -- segments -------------------------------------------------------------------------


def add_segments(
    df: DataFrame,
    expected: str = "1s",
    policy: str = "segment",
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
    plain: bool = False,
) -> DataFrame:
    """Number maximal runs of rows spaced exactly ``expected`` apart, from 1.

    policy -- "segment": a gap starts a new segment
              "drop": rows after a gap are removed first, the rest is renumbered
              "reindex_fill": missing points of the grid are added and filled forward
    """
    step = interval_micros(expected)
    ts = order[0]
    if policy == "reindex_fill":
        df = reindex_fill(df, expected, by=by, ts=ts)
    elif policy not in ("segment", "drop"):
        raise ValueError(f"unknown gap policy: {policy}")

    def gaps(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumn("__gap", gap_micros(w, ts))

    rows = Ordered(df, by, order, plain=plain and policy != "reindex_fill").windows(gaps, back=1)
    if policy == "drop":
        kept = rows.where(F.col("__gap").isNull() | (F.col("__gap") == step)).drop("__gap")
        rows = Ordered(kept, by, order).windows(gaps, back=1)
    breaks = F.when(F.col("__gap") == step, 0).otherwise(1)
    return Ordered(rows, by, order).running_sum(segment_id=breaks).drop("__gap")


def gap_segments(
    df: DataFrame, longer_than: str, *, by: Sequence[str] = ("symbol",), order: Sequence[str] = ("ts",), plain: bool = False
) -> DataFrame:
    """Like ``add_segments`` for irregular series: only a gap longer than the given
    time starts a new segment."""
    limit, ts = interval_micros(longer_than), order[0]
    rows = Ordered(df, by, order, plain=plain).windows(
        lambda d, w: d.withColumn("__gap", gap_micros(w, ts)), back=1
    )
    breaks = F.when(F.col("__gap") <= limit, 0).otherwise(1)
    return Ordered(rows, by, order).running_sum(segment_id=breaks).drop("__gap")


def reindex_fill(
    df: DataFrame, every: str = "1s", *, by: Sequence[str] = ("symbol",), ts: str = "ts"
) -> DataFrame:
    """Complete each series to a regular grid and fill the new rows forward."""
    from tickspark.operators.align import span_grid

    grid = span_grid([df], every, by=by, ts=ts)
    return forward_fill(grid.join(df, [*by, ts], "left"), by=by, order=[ts]).select(*df.columns)


def drop_short_segments(
    df: DataFrame, min_len: int, *, by: Sequence[str] = ("symbol",), segment: str = "segment_id"
) -> DataFrame:
    """Keep segments of at least ``min_len`` rows; a NULL key is a series like any other."""
    keys = [*by, segment]
    own = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    long = df.groupBy(*own).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_len)
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return df.join(long, same, "left_semi")


def drop_null_rows(df: DataFrame, columns: Sequence[str], *, finite: bool = False) -> DataFrame:
    """Rows with a value in every column; ``finite`` also rejects NaN and infinity."""
    out = df.dropna(subset=list(columns))
    if finite:
        for c in columns:
            x = F.col(c).cast("double")
            out = out.where(~F.isnan(x) & (F.abs(x) != float("inf")))
    return out


def drop_outliers(df: DataFrame, column: str = "price_change_pct", limit: float = 1.0) -> DataFrame:
    return df.where(F.abs(column) < limit)


# -- reports ---------------------------------------------------------------------------


@dataclass(frozen=True)
class QualityRules:
    required: tuple[str, ...] = ("ts_ms",)
    ts: str = "ts_ms"
    expected_dt: int = 1000
    near_constant_std: float = 1e-8
    q_low: float = 0.001
    q_high: float = 0.999


def quality_report(
    df: DataFrame, rules: QualityRules = QualityRules(), *, strict: bool = True, plain: bool = False
) -> DataFrame:
    """One row about a table with an integer time column: rows, time range,
    duplicates, step statistics and constant columns. ``strict`` raises on missing
    columns, NULL or NaN, infinities and duplicate times. The table is read twice, once for its
    values and once for its times; ``plain`` is accepted and has no effect."""
    missing = [c for c in rules.required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    ts = rules.ts
    numeric = numeric_columns(df)
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]

    def any_of(conditions: list[Column]) -> Column:
        out = F.lit(False)
        for c in conditions:
            out = out | c
        return out

    null = any_of([F.col(c).isNull() for c in df.columns] + [F.isnan(c) for c in floats])
    inf = any_of([F.abs(c) == float("inf") for c in floats])
    others = [c for c in numeric if c != ts]
    first = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(null).alias("rows_with_null"),
        F.count_if(F.coalesce(inf, F.lit(False))).alias("rows_with_inf"),
        F.min(ts).alias("ts_min"),
        F.max(ts).alias("ts_max"),
        F.count_if(F.col(ts).isNull()).alias("no_ts"),
        _names({c: (F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1))) for c in others}, "constant_cols"),
        _names({c: F.stddev_samp(c) < rules.near_constant_std for c in others}, "near_constant_cols"),
    ).first()
    steps = step_counts(df, ts)
    n = F.sum("n")
    step = steps.agg(
        F.min("dt").alias("dt_min"),
        F.max("dt").alias("dt_max"),
        (100 * F.sum(F.when(F.col("dt") == rules.expected_dt, F.col("n")).otherwise(0)) / n).alias("pct_dt_expected"),
        F.coalesce(F.sum(F.when(F.col("dt") == 0, F.col("n"))), F.lit(0)).alias("ts_duplicates"),
    ).first()
    median = exact_quantiles(steps, ["dt"], [0.5], weight="n")["dt"][0]
    n_dups = step["ts_duplicates"] + max(0, first["no_ts"] - 1)
    if strict:
        if first["rows_with_null"]:
            raise ValueError("NULL or NaN values found")
        if first["rows_with_inf"]:
            raise ValueError("infinite values found")
        if n_dups:
            raise ValueError("duplicate times found")
    row = (
        *(first[c] for c in ("rows", "rows_with_null", "rows_with_inf", "ts_min", "ts_max")),
        n_dups,
        step["dt_min"],
        median,
        step["dt_max"],
        step["pct_dt_expected"],
        first["constant_cols"],
        first["near_constant_cols"],
    )
    schema = (
        "rows bigint, rows_with_null bigint, rows_with_inf bigint, ts_min bigint, ts_max bigint, "
        "ts_duplicates bigint, dt_min bigint, dt_median double, dt_max bigint, pct_dt_expected double, "
        "constant_cols array<string>, near_constant_cols array<string>"
    )
    return df.sparkSession.createDataFrame([row], schema)


def step_counts(df: DataFrame, ts: str) -> DataFrame:
    """(dt, n): how often each step occurs between a time and the next one, NULL times left out.

    One sort: times are cut into ranges, each of which is summed up by its steps, its first and
    its last time; the ranges are then joined at their ends. Equal times may be cut apart."""
    times = df.select(F.col(ts).cast("bigint").alias("ts"), F.monotonically_increasing_id().alias("tie"))
    ranged = times.where("ts IS NOT NULL").repartitionByRange("ts", "tie").sortWithinPartitions("ts", "tie")
    parts = stage(ranged.select("ts").mapInArrow(_range_steps(), "first long, last long, dt long, n long"))
    # One row per range. Ranges of one time only may agree in both ends: their steps are 0.
    ends = parts.where("first IS NOT NULL")
    between = F.col("first") - F.lag("last").over(Window.orderBy("first", "last"))
    joints = ends.select(between.alias("dt"), F.lit(1).cast("bigint").alias("n")).where("dt IS NOT NULL")
    return parts.where("dt IS NOT NULL").select("dt", "n").unionByName(joints).groupBy("dt").agg(F.sum("n").alias("n"))


def _range_steps() -> Callable[[Iterator], Iterator]:
    """Function over the sorted times of a range: (first, last) once, and (dt, n) per step."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        first = last = None
        seen = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for batch in batches:
            times = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(times):
                continue
            if first is None:
                first = int(times[0])
                steps = np.diff(times)
            else:
                steps = np.diff(times, prepend=last)
            last = int(times[-1])
            dt, n = np.unique(steps, return_counts=True)
            new, where = np.unique(np.concatenate([seen[0], dt]), return_inverse=True)
            total = np.zeros(len(new), dtype=np.int64)
            np.add.at(total, where, np.concatenate([seen[1], n]))
            seen = new, total
        if first is not None:
            none = [None] * len(seen[0])
            columns = ([first, *none], [last, *none], [None, *seen[0].tolist()], [None, *seen[1].tolist()])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["first", "last", "dt", "n"])

    return run


def _names(conditions: dict[str, Column], alias: str) -> Column:
    """The names whose condition holds."""
    if not conditions:
        return F.array().cast("array<string>").alias(alias)
    return F.array_compact(F.array(*[F.when(c, n) for n, c in conditions.items()])).alias(alias)


def is_sorted(df: DataFrame, arrival: str, ts: str = "ts_ms", *, plain: bool = False) -> DataFrame:
    """One row: whether time never falls along the arrival order, and where it does.
    Spark tables have no row order of their own, so the arrival column has to say it."""
    steps = Ordered(df.select(arrival, ts), [], [arrival], plain=plain).windows(
        lambda d, w: d.withColumn("__back", F.col(ts) < F.lag(ts).over(w)), back=1
    )
    return steps.agg(
        (F.count_if("__back") == 0).alias("ts_monotonic_increasing"), F.count_if("__back").alias("steps_back")
    )


def outlier_bounds(df: DataFrame, columns: Sequence[str], rules: QualityRules = QualityRules()) -> DataFrame:
    """(column, q_low, q_high) at the outlier quantiles."""
    q = exact_quantiles(df, columns, [rules.q_low, rules.q_high])
    rows = [(c, q[c][0], q[c][1]) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column string, q_low double, q_high double")


def compare_splits(
    train: DataFrame, val: DataFrame, test: DataFrame, ts: str = "ts_ms", *, strict: bool = True, by: Sequence[str] = ()
) -> DataFrame:
    """One row, or one per group of ``by``: bounds of the three splits, overlaps and the gaps between them.
    Different columns, and in strict mode overlapping times, raise."""
    if not train.columns == val.columns == test.columns:
        raise ValueError("splits have different columns")
    parts = {"train": train, "val": val, "test": test}
    bounds = union_all([df.select(*by, F.lit(n).alias("split"), F.col(ts).alias("t")) for n, df in parts.items()])
    wide = bounds.groupBy(*by).agg(
        *[f(F.when(F.col("split") == n, F.col("t"))).alias(f"{n}_{e}") for n in parts for e, f in (("min", F.min), ("max", F.max))]
    )
    out = wide.select(
        "*",
        (F.col("train_max") >= F.col("val_min")).alias("train_val_overlap"),
        (F.col("val_max") >= F.col("test_min")).alias("val_test_overlap"),
        (F.col("val_min") - F.col("train_max")).alias("gap_train_to_val"),
        (F.col("test_min") - F.col("val_max")).alias("gap_val_to_test"),
    )
    if strict:
        if out.where(F.col("train_val_overlap") | F.col("val_test_overlap")).limit(1).count():
            raise ValueError("splits overlap in time")
    return out


def require_classes(df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    """Raise when a split holds fewer than two classes, else return the class counts."""
    counts = df.groupBy(split).agg(F.count_distinct(label).alias("classes"))
    poor = [r[split] for r in counts.where(F.col("classes") < 2).collect()]
    if poor:
        raise ValueError(f"fewer than two classes in {poor}")
    return counts


def store_summary(book: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One row about order-book snapshots."""
    return book.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array_sort(F.collect_set("symbol")).alias("symbols"),
        F.min(ts).alias("start"),
        F.max(ts).alias("end"),
        F.min("mid_price").alias("min_mid"),
        F.max("mid_price").alias("max_mid"),
        F.avg("spread_bps").alias("avg_spread_bps"),
    )


def source_availability(df: DataFrame, sources: dict[str, Sequence[str]]) -> DataFrame:
    """Features of each source present in a unified table, and rows with any value."""
    have = {name: [c for c in columns if c in df.columns] for name, columns in sources.items()}
    filled = {
        name: F.greatest(F.lit(0), *[F.col(c).isNotNull().cast("int") for c in columns])
        for name, columns in have.items()
        if columns
    }
    rows = df.agg(F.count(F.lit(1)), *[F.sum(c).alias(n) for n, c in filled.items()]).first()
    table = [(n, bool(c), len(c), rows[n] or 0 if c else 0) for n, c in have.items()]
    return df.sparkSession.createDataFrame(table, "source string, available boolean, n_features int, n_rows bigint")
