"""Exploratory tables: the numbers behind charts and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.functions.expr import div, numeric_columns
from tickspark.operators.align import union_all
from tickspark.operators.quantiles import exact_quantiles
from tickspark.operators.splits import systematic
from tickspark.session import stage

# Values one task sorts or brings together for ranks, whatever the size of the table.
RANKED = 500_000


def target_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std, min, max, q01, q50, q99) of each target."""
    q = exact_quantiles(df, columns, [0.01, 0.5, 0.99])
    x = {c: F.col(c).cast("double") for c in columns}
    picks = [
        f(x[c]).alias(f"{n}{i}")
        for i, c in enumerate(columns)
        for n, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ]
    row = df.agg(*picks).first()
    rows = [(c, row[f"mean{i}"], row[f"std{i}"], row[f"min{i}"], row[f"max{i}"], *q[c]) for i, c in enumerate(columns)]
    schema = "column string, mean double, std double, min double, max double, q01 double, q50 double, q99 double"
    return df.sparkSession.createDataFrame(rows, schema)


def class_share(df: DataFrame, column: str) -> DataFrame:
    """(class, n, share): the class counts, and each as a part of all rows."""
    counts = df.groupBy(F.col(column).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", div("n", df.agg(F.count(F.lit(1))).scalar()))


def histogram(df: DataFrame, column: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """(by.., bin, bin_start, n): equal-width bins between the extremes, the last
    one closed. Empty bins do not appear."""
    x = F.col(column).cast("double")
    known = df.where(x.isNotNull() & ~F.isnan(x))
    lo, hi = known.agg(F.min(x), F.max(x)).first()
    if lo is None:
        lo = hi = 0.0
    width = (hi - lo) / bins
    if width == 0:
        at = F.lit(0).cast("bigint")
    else:
        at = F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("bigint")
    out = known.groupBy(*by, at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("bin_start", F.lit(lo) + F.col("bin") * F.lit(width))


def pearson(df: DataFrame, columns: Sequence[str], others: Sequence[str] | None = None) -> DataFrame:
    """(a, b, corr) for every pair of columns, or of ``columns`` x ``others``, in one
    aggregation. At most 30 columns keep the generated code small."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in (others or columns[i:])]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]).first()
    table = [(a, b, row[f"c{i}"]) for i, (a, b) in enumerate(pairs)]
    return df.sparkSession.createDataFrame(table, "a string, b string, corr double")


def average_ranks(df: DataFrame, row: str, columns: Sequence[str]) -> DataFrame:
    """(row, column, rank): the average rank of every value in its column, for all columns at
    once and with one shuffle. NULL and NaN have to be dropped before.

    The values are sorted in ranges of (column, value, row), so that a column of any size and a
    value that fills much of one are spread over many tasks. Each task numbers the runs of equal
    values in its range; runs that touch its ends are joined with those of its neighbours
    through a table of one row per range and column. The number of ranges follows the number of
    values, so that a task's memory does not.
    """
    long = df.unpivot([row], list(columns), "column", "value")
    order = ["column", "value", row]
    ordered = long.repartitionByRange(*_tasks(df, columns), *order).sortWithinPartitions(*order)
    schema = f"part int, column string, `{row}` long, value double, first long, last long"
    runs = stage(ordered.select("column", F.col(row).alias("row"), "value").mapInArrow(_runs(), schema))
    spans = runs.groupBy("column", "part").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        (F.max(F.when(F.col("first") == 0, F.col("last"))) + 1).alias("head"),
        F.max("first").alias("tail_at"),
    )
    earlier = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    heads = spans.select("column", F.col("low").alias("value"), F.col("offset").alias("at"), F.col("head").alias("size"))
    tails = spans.where("tail_at > 0").select(
        "column", F.col("high").alias("value"), (F.col("offset") + F.col("tail_at")).alias("at"), (F.col("n") - F.col("tail_at")).alias("size")
    )
    edges = heads.unionByName(tails).groupBy("column", "value").agg(F.min("at").alias("at"), F.sum("size").alias("size"))
    edges = edges.select("column", "value", (F.col("at") + (F.col("size") + 1) / 2).alias("rank"))
    # One row per range and column, and two values of each.
    spans = spans.join(edges.select("column", F.col("value").alias("low"), F.col("rank").alias("head_rank")), ["column", "low"])
    spans = spans.join(edges.select("column", F.col("value").alias("high"), F.col("rank").alias("tail_rank")), ["column", "high"])
    marked = runs.join(F.broadcast(spans.select("column", "part", "n", "offset", "head_rank", "tail_rank")), ["column", "part"])
    inner = F.col("offset") + (F.col("first") + F.col("last")) / 2 + 1
    rank = F.when(F.col("first") == 0, F.col("head_rank")).when(F.col("last") == F.col("n") - 1, F.col("tail_rank"))
    return marked.select(row, "column", rank.otherwise(inner).alias("rank"))


def _tasks(df: DataFrame, columns: Sequence[str]) -> list[int]:
    """Number of tasks for the values of the columns; none given where they fit one."""
    tasks = ceil(df.count() * len(columns) / RANKED)
    return [tasks] if tasks > 1 else []


def _runs() -> Callable[[Iterator], Iterator]:
    """Function over the rows of a sorted range: the first and last place of each row's run of
    equal values, by column. Beside one batch a task holds the rows of the run still open."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        open_rows: list = []  # row numbers of the last run
        open_key, open_at = None, 0

        def batch_of(column, rows, value, first, last):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(rows), part), pa.int32()),
                    pa.array([column] * len(rows), pa.string()),
                    pa.array(rows, pa.int64()),
                    pa.array(value, pa.float64()),
                    pa.array(first, pa.int64()),
                    pa.array(last, pa.int64()),
                ],
                names=["part", "column", "row", "value", "first", "last"],
            )

        def closed():
            last_at = open_at + sum(map(len, open_rows)) - 1
            for rows in open_rows:  # batches no larger than those that came in
                first, last = np.full(len(rows), open_at), np.full(len(rows), last_at)
                yield batch_of(open_key[0], rows, np.full(len(rows), open_key[1]), first, last)

        for batch in batches:
            names = batch.column(0).dictionary_encode()
            codes = names.indices.to_numpy(zero_copy_only=False)
            rows = batch.column(1).to_numpy(zero_copy_only=False)
            value = batch.column(2).to_numpy(zero_copy_only=False)
            if not len(rows):
                continue
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (codes[1:] != codes[:-1]) | (value[1:] != value[:-1])
            cuts = np.append(np.flatnonzero(new), len(rows))
            for column in range(len(names.dictionary)):
                name = names.dictionary[column].as_py()
                here = np.flatnonzero(codes == column)
                if not len(here):
                    continue
                lo, hi = int(here[0]), int(here[-1]) + 1
                if open_key is None or open_key[0] != name:
                    if open_key is not None:
                        yield from closed()
                    open_key, open_rows, open_at = (name, value[lo]), [], 0
                starts = cuts[(cuts >= lo) & (cuts < hi)]
                ends = np.append(starts[1:], hi)
                at = lo
                if open_key[1] == value[lo]:  # the open run goes on
                    open_rows.append(rows[lo : ends[0]])
                    at = int(ends[0])
                    starts, ends = starts[1:], ends[1:]
                if len(starts):
                    yield from closed()
                    inner = slice(at, int(starts[-1]))  # whole runs; the last one stays open
                    base = open_at + sum(map(len, open_rows)) - at
                    sizes = (ends - starts)[:-1]
                    first = np.repeat(starts[:-1] + base, sizes)
                    last = np.repeat(ends[:-1] - 1 + base, sizes)
                    yield batch_of(name, rows[inner], value[inner], first, last)
                    open_key, open_rows, open_at = (name, value[starts[-1]]), [rows[starts[-1] : hi]], int(starts[-1]) + base
        if open_key is not None:
            yield from closed()

    return run


def spearman(df: DataFrame, columns: Sequence[str], others: Sequence[str] | None = None) -> DataFrame:
    """(a, b, corr) of average ranks over the rows where every column has a value. Two shuffles
    of the values, whatever the number of columns: one to rank them, one to bring the ranks of
    a row together."""
    names = list(dict.fromkeys([*columns, *(others or ())]))
    known = df.select(*[(F.col(c).cast("double") + 0.0).alias(c) for c in names]).dropna()
    known = stage(known.withColumn("__row", F.monotonically_increasing_id()))
    ranks = average_ranks(known, "__row", names)
    picks = [F.max(F.when(F.col("column") == c, F.col("rank"))).alias(c) for c in names]
    # Dealt by row before they are summed up: a range holds a row's values once at most, so summing
    # up before the shuffle would keep all rows of a range and gain nothing.
    dealt = ranks.repartition(*_tasks(known, names), "__row")
    return pearson(dealt.groupBy("__row").agg(*picks), columns, others)


def describe(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.01, 0.5, 0.99)) -> DataFrame:
    """(statistic, one column each): count, mean, std, min, exact percentiles, max."""
    q = exact_quantiles(df, columns, probs)
    x = {c: F.col(c).cast("double") for c in columns}
    aggs = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[f(x[c]).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in aggs.items()]).first()

    def line(n: str) -> tuple:
        return (n, *[None if (v := row[f"{n}{i}"]) is None else float(v) for i in range(len(columns))])

    rows = [line(n) for n in ("count", "mean", "std", "min")]
    rows += [(f"{100 * p:g}%", *[q[c][j] for c in columns]) for j, p in enumerate(probs)]
    rows.append(line("max"))
    schema = ", ".join(["statistic string", *[f"`{c}` double" for c in columns]])
    return df.sparkSession.createDataFrame(rows, schema)


def profile(df: DataFrame, columns: Sequence[str] | None = None, *, approximate: bool = False) -> DataFrame:
    """(column, n, nulls, distinct, min, max, mean, std, zeros) of numeric columns.
    Exact distinct counts expand every row once per column before the shuffle;
    ``approximate`` uses a sketch instead."""
    names = list(columns or numeric_columns(df))
    long = df.select(*[F.col(c).cast("double").alias(c) for c in names]).unpivot([], names, "column", "value")
    v = F.col("value")
    if approximate:
        return long.groupBy("column").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(v.isNull()).alias("nulls"),
            F.approx_count_distinct(v).alias("distinct"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"),
            F.count_if(v == 0).alias("zeros"),
        )
    return long.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(v.isNull()).alias("nulls"),
        F.count_distinct(v).alias("distinct"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.count_if(v == 0).alias("zeros"),
    )


# -- signals and fills ------------------------------------------------------------------


def fill_rate(labelled: DataFrame, column: str, flag: str = "had_fill") -> DataFrame:
    """(column, n_signals, n_filled, fill_rate) by symbol or signal value."""
    out = labelled.groupBy(column).agg(F.count(F.lit(1)).alias("n_signals"), F.sum(flag).alias("n_filled"))
    return out.withColumn("fill_rate", div("n_filled", "n_signals"))


def signal_counts(signals: DataFrame, *columns: str) -> DataFrame:
    """Signals per combination of the given columns."""
    return signals.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def fill_volume_by_signal(unified: DataFrame) -> DataFrame:
    """Fill volume by the last signal in force."""
    return unified.groupBy("last_signal").agg(F.sum("fill_volume").alias("fill_volume"), F.count(F.lit(1)).alias("n"))


def hourly_return(bars: DataFrame, *, ret: str = "log_return", ts: str = "ts") -> DataFrame:
    """Mean return by hour of day."""
    return bars.groupBy(F.hour(ts).alias("hour")).agg(F.avg(ret).alias("mean_return"), F.count(ret).alias("n"))


# -- summaries ----------------------------------------------------------------------------


def dataset_summary(df: DataFrame, features: Sequence[str], label: str = "label", split: str = "split") -> DataFrame:
    """(split, rows, n_features, label counts) of a split dataset."""
    name = F.coalesce(F.col(label).cast("string"), F.lit("null"))
    counts = df.groupBy(split, name.alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(split).agg(
        F.sum("n").alias("rows"),
        F.lit(len(features)).alias("n_features"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("class", "n")))).alias("label_distribution"),
    )


def symbol_summary(bars: DataFrame, *, ts: str = "ts", symbol: str = "symbol") -> DataFrame:
    """Bars, time range, volume and trades per symbol."""
    return bars.groupBy(symbol).agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.min(ts).alias("start"),
        F.max(ts).alias("end"),
        F.sum("volume").alias("volume"),
        F.sum("num_trades").alias("num_trades"),
        F.avg("log_return").alias("mean_return"),
        F.stddev_samp("log_return").alias("std_return"),
    )


# The series a panel shows, by what their names hold, and how many.
PANELS = {
    "Price": (("price", "close", "mid"), 4),
    "Volume": (("volume", "n_fills"), 3),
    "Signal": (("signal",), 3),
    "Order Book": (("spread", "imbalance"), 3),
}


def panel_columns(df: DataFrame) -> dict[str, list[str]]:
    """Columns each chart panel would show."""
    out = {}
    for panel, (parts, most) in PANELS.items():
        names = [
            c
            for c in df.columns
            if any(p in c.lower() for p in parts) and not any(d in c for d in ("_lag", "_ma", "_std"))
        ]
        if names:
            out[panel] = names[:most]
    if "label" in df.columns:
        out["Label"] = ["label"]
    return out


def plot_series(
    df: DataFrame,
    columns: Sequence[str],
    max_rows: int = 2000,
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Every k-th row of the given series, at most about ``max_rows`` per symbol."""
    return systematic(df.select(*dict.fromkeys([*by, *order, *columns])), max_rows, by=by, order=order)


def target_report(
    df: DataFrame, returns: Sequence[str] = (), directions: Sequence[str] = (), volatilities: Sequence[str] = ()
) -> DataFrame:
    """(target, metric, value) over return, direction and volatility targets:
    statistics, class shares and simple baselines."""
    regressions = [*returns, *volatilities]
    parts = []
    if regressions:
        stats = target_stats(df, regressions)
        names = [c for c in stats.columns if c != "column"]
        parts.append(stats.unpivot(["column"], names, "metric", "value").withColumnRenamed("column", "target"))
        mean = df.agg(*[F.avg(c).alias(c) for c in volatilities]).first() if volatilities else {}
        base: list[Column] = [F.avg(F.col(c) * F.col(c)).alias(f"{c}|mse_pred0") for c in returns]
        base += [F.avg(F.abs(F.col(c) - F.lit(mean[c]))).alias(f"{c}|mae_predmean") for c in volatilities]
        row = df.agg(*base).first()
        rows = [(*n.split("|"), row[n]) for n in row.asDict()]
        parts.append(df.sparkSession.createDataFrame(rows, "target string, metric string, value double"))
    for c in directions:
        shares = class_share(df.where(F.col(c).isNotNull()), c)
        at = F.col("class").cast("string")
        parts.append(
            shares.select(F.lit(c).alias("target"), F.concat(F.lit("n_"), at).alias("metric"), F.col("n").cast("double").alias("value"))
        )
        parts.append(
            shares.agg(
                F.count(F.lit(1)).cast("double").alias("unique"),
                (F.max("share") * 100).alias("pct_majority"),
                F.max("share").alias("acc_majority"),
                div(F.lit(1.0), F.count(F.lit(1))).alias("bal_acc_majority"),
            )
            .unpivot([], ["unique", "pct_majority", "acc_majority", "bal_acc_majority"], "metric", "value")
            .select(F.lit(c).alias("target"), "metric", "value")
        )
    return union_all(parts)
