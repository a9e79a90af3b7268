"""Time grids, as-of alignment and the equi joins between sources.

An as-of join here is a union of both sides in time order and a carried last value,
so it is one shuffle whatever the number of sources, never a range join, and an
oversized symbol is cut into ranges like any other ordered operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions.expr import interval_micros, micros
from tickspark.operators.ordered import Ordered

GRID_STEP = 4096


# -- grids -------------------------------------------------------------------------


def time_grid(
    spark: SparkSession,
    start: dt.datetime,
    end: dt.datetime,
    every: str = "1s",
    symbols: Sequence[str] | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Regular naive timestamps from start to end, for each symbol if given. The
    grid is generated by the tasks, not as one array."""
    length = interval_micros(every)
    n = (end - start) // dt.timedelta(microseconds=length) + 1
    origin = micros(F.lit(start).cast("timestamp_ntz"))
    at = F.timestamp_micros(origin + F.col("id") * length).cast("timestamp_ntz")
    grid = spark.range(max(n, 0)).select(at.alias(ts))
    if symbols is None:
        return grid
    return grid.select(F.explode(F.array(*[F.lit(s) for s in symbols])).alias("symbol"), ts)


def span_grid(
    sources: Sequence[DataFrame],
    every: str = "1s",
    *,
    by: Sequence[str] = ("symbol",),
    ts: str = "ts",
    common: bool = False,
) -> DataFrame:
    """Per-series grid from the first to the last time over all sources, or with
    ``common`` over the time that every source covers. Long spans are expanded in
    two steps, so no row holds a whole span."""
    spans = union_all(
        [s.groupBy(*by).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi")) for s in sources]
    )
    lo, hi = (F.max("__lo"), F.min("__hi")) if common else (F.min("__lo"), F.max("__hi"))
    span = spans.groupBy(*by).agg(lo.alias("__lo"), hi.alias("__hi"), F.count(F.lit(1)).alias("__sources"))
    if common:
        span = span.where(F.col("__sources") == len(sources))
    length = interval_micros(every)
    steps = F.floor((micros("__hi") - micros("__lo")) / length).cast("bigint")
    span = span.withColumn("__n", steps).where(F.col("__n") >= 0)
    blocks = span.withColumn(
        "__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("__n") / GRID_STEP).cast("bigint")))
    )
    blocks = blocks.repartition(*by, "__block")
    first = F.col("__block") * GRID_STEP
    last = F.least(first + GRID_STEP - 1, F.col("__n"))
    points = blocks.withColumn("__i", F.explode(F.sequence(first, last)))
    at = F.timestamp_micros(micros("__lo") + F.col("__i") * length)
    return points.select(*by, at.cast(sources[0].schema[ts].dataType).alias(ts))


# -- as-of -------------------------------------------------------------------------


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    on: str = "ts",
    by: Sequence[str] = ("symbol",),
    direction: str = "backward",
    tolerance: str | None = None,
    tiebreak: Sequence[str] = (),
    matched: str | None = None,
) -> DataFrame:
    """Attach to each left row the right row nearest in time within its series.

    direction -- "backward": the last right row at or before; "forward": the first
                 at or after; "nearest": the closer of the two, earlier on a tie;
                 "exact": equal times only
    tolerance -- greatest distance, such as "5s"; farther rows do not match
    tiebreak  -- right columns that order right rows of equal time
    matched   -- name of a column that receives the time of the matched row

    The whole right row is taken, NULLs included. Left rows without a match get NULL.
    """
    if direction not in ("backward", "forward", "nearest", "exact"):
        raise ValueError(f"unknown direction: {direction}")
    # Only the neighbour at or before can be equal in time on the backward side.
    backward = direction in ("backward", "nearest", "exact")
    forward = direction in ("forward", "nearest")
    taken = [c for c in right.columns if c not in {on, *by}]
    clash = set(taken) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    found = {}
    if backward:
        found["__b"] = False
    if forward:
        found["__f"] = True
    rows = left
    for name, ahead in found.items():
        rows = _carry(rows, right, on, by, tiebreak, taken, name, ahead)
    if direction == "nearest":
        back, fwd = _distance("__b", on), _distance("__f", on)
        nearer_ahead = F.col("__f").isNotNull() & (F.col("__b").isNull() | (fwd < back))
        pick = F.when(nearer_ahead, F.col("__f")).otherwise(F.col("__b"))
    else:
        pick = F.col(next(iter(found)))
    rows = rows.withColumn("__hit", pick).drop("__b", "__f")
    limit = 0 if direction == "exact" else interval_micros(tolerance) if tolerance else None
    if limit is not None:
        rows = rows.withColumn("__hit", F.when(_distance("__hit", on) <= limit, F.col("__hit")))
    return rows.select(
        *left.columns,
        *[F.col("__hit")[c].alias(c) for c in taken],
        *([F.col("__hit")["__at"].alias(matched)] if matched else []),
    )


def _distance(hit: str, on: str) -> Column:
    return F.abs(micros(F.col(hit)["__at"]) - micros(on))


def _spread(df: DataFrame, columns: Sequence[str]) -> Column:
    """Orders rows of equal time arbitrarily but repeatably, so that many of them
    can still be cut into ranges."""
    plain = [c for c in columns if not df.schema[c].dataType.typeName().startswith(("map", "variant"))]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("bigint")


def _carry(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str],
    tiebreak: Sequence[str],
    taken: Sequence[str],
    name: str,
    ahead: bool,
) -> DataFrame:
    """Left rows with the right row before (or ahead of) each as a struct."""
    own = [c for c in left.columns if c not in {on, *by}]
    # At equal times the right row has to be reached first in the carry direction.
    right_side, left_side = (1, 0) if ahead else (0, 1)
    ties = [f"__tie{i}" for i in range(len(tiebreak))]
    known = right.where(F.col(on).isNotNull())
    for c in by:
        known = known.where(F.col(c).isNotNull())
    r = known.select(
        *by,
        F.col(on),
        F.lit(right_side).alias("__side"),
        *[F.col(c).alias(t) for c, t in zip(tiebreak, ties)],
        F.lit(0).cast("bigint").alias("__mix"),
        F.struct(*[F.col(c) for c in taken], F.col(on).alias("__at")).alias(name),
    )
    rest = F.struct(*[F.col(c) for c in own], F.lit(1).alias("__is")) if own else F.struct(F.lit(1).alias("__is"))
    le = left.select(
        *by,
        F.col(on).cast(right.schema[on].dataType).alias(on),
        F.lit(left_side).alias("__side"),
        _spread(left, own).alias("__mix"),
        rest.alias("__left"),
    )
    both = r.unionByName(le, allowMissingColumns=True)
    ordered = Ordered(both, by, [on, "__side", *ties, "__mix"])
    out = ordered.last_known(ahead=ahead, **{"__found": F.col(name)}).where(F.col("__left").isNotNull())
    return out.select(*by, on, *[F.col("__left")[c].alias(c) for c in own], F.col("__found").alias(name)).select(
        *left.columns, name
    )


def asof_chain(
    grid: DataFrame,
    sources: Mapping[str, DataFrame],
    *,
    on: str = "ts",
    by: Sequence[str] = ("symbol",),
    counts: Sequence[str] = (),
    carry_counts: bool = False,
) -> DataFrame:
    """Align several bar tables to a grid: one union, one shuffle, one pass.

    Bars are unique per (series, time). ``counts`` names columns that count events
    of their own bar: a grid point without a bar of its own gets 0 for them unless
    ``carry_counts`` repeats the last bar's value.
    """
    times = [grid.select(*grid.columns, F.lit(1).alias("__side"))]
    for name, src in sources.items():
        cols = [c for c in src.columns if c not in {on, *by}]
        payload = F.struct(*[F.col(c) for c in cols], F.col(on).alias("__at"))
        known = src.where(F.col(on).isNotNull())
        times.append(known.select(*by, on, F.lit(0).alias("__side"), payload.alias(f"__{name}")))
    both = times[0]
    for t in times[1:]:
        both = both.unionByName(t, allowMissingColumns=True)
    ordered = Ordered(both, by, [on, "__side"])
    carried = ordered.last_known(**{f"__on_{n}": F.col(f"__{n}") for n in sources})
    carried = carried.where(F.col("__side") == 1)
    out = [F.col(c) for c in grid.columns]
    for name, src in sources.items():
        hit = F.col(f"__on_{name}")
        here = hit["__at"] == F.col(on)
        for c in src.columns:
            if c in {on, *by}:
                continue
            value = hit[c]
            if c in counts and not carry_counts:
                value = F.when(here, value).when(hit.isNotNull(), F.lit(0).cast(src.schema[c].dataType))
            out.append(value.alias(c))
    return carried.select(*out)


def fill_within(
    signals: DataFrame,
    fills: DataFrame,
    seconds: float = 60.0,
    *,
    on: str = "ts",
    by: Sequence[str] = ("symbol",),
) -> DataFrame:
    """Whether a fill of the same series follows each signal within ``seconds``
    (at the same time counts), and how long it took. Only the next fill matters, so
    this is a forward as-of join and no pairs are formed."""
    marks = fills.select(*by, on, F.lit(1).alias("__fill"))
    out = asof_join(
        signals,
        marks,
        on=on,
        by=by,
        direction="forward",
        tolerance=f"{round(seconds * 1_000_000)}us",
        matched="fill_ts",
    )
    delay = (micros("fill_ts") - micros(on)) / 1_000_000
    out = out.withColumns({"had_fill": F.col("fill_ts").isNotNull().cast("int"), "fill_delay_s": delay})
    return out.drop("__fill")


# -- equi joins ------------------------------------------------------------------------


def left_matrix(grid: DataFrame, *sources: DataFrame, on: Sequence[str] = ("symbol", "ts")) -> DataFrame:
    """Left-join bucketed sources to the grid on (symbol, ts)."""
    out = grid
    for src in sources:
        out = out.join(src, list(on), "left")
    return out


def cross_asset(
    bars: DataFrame,
    target: str,
    others: Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    ts: str = "ts",
    symbol: str = "symbol",
) -> DataFrame:
    """Rows of the target symbol with the other symbols' columns of the same time,
    suffixed ``_{symbol}``. All others are gathered in one aggregation by time."""
    if columns is None:
        columns = [c for c in bars.columns if not c.startswith("y_") and c not in (ts, symbol)]
    wide = (
        bars.where(F.col(symbol).isin(list(others)))
        .groupBy(ts)
        .agg(
            *[
                F.max(F.when(F.col(symbol) == s, F.col(c))).alias(f"{c}_{s.lower()}")
                for s in others
                for c in columns
            ]
        )
    )
    return bars.where(F.col(symbol) == target).join(wide, ts, "left")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def symbol_stats(signals: DataFrame, fills: DataFrame) -> DataFrame:
    """Signals and fills per symbol, 0 where a source has none."""
    s = signals.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_signals"))
    f = fills.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_fills"))
    return s.join(f, "symbol", "full_outer").na.fill(0, ["n_signals", "n_fills"])


def time_ranges(sources: Mapping[str, DataFrame], ts: str = "ts") -> DataFrame:
    """First and last time of each source."""
    parts = [
        df.agg(F.min(ts).alias("start"), F.max(ts).alias("end")).select(F.lit(n).alias("source"), "start", "end")
        for n, df in sources.items()
    ]
    return union_all(parts)


def overlap(sources: Mapping[str, DataFrame], ts: str = "ts") -> DataFrame:
    """The time range all non-empty sources cover."""
    return time_ranges(sources, ts).agg(F.max("start").alias("start"), F.min("end").alias("end"))


def available_symbols(sources: Sequence[DataFrame]) -> DataFrame:
    parts = [s.select("symbol").distinct() for s in sources]
    return union_all(parts).where(F.col("symbol").isNotNull()).distinct()
