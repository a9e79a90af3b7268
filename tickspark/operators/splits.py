"""Leak-free splits and samples. Splits return the frame with a ``split`` column;
rows inside an embargo are left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.functions.expr import micros
from tickspark.operators.ordered import Ordered

# Default ratios and embargo.
TRAIN, VAL = 0.70, 0.15
EMBARGO = 60


def positions(
    df: DataFrame, by: Sequence[str], order: Sequence[str], *, plain: bool = False, **whole: Column
) -> DataFrame:
    """0-based position ``__i`` in the series, its length ``__n`` and aggregates over
    the whole series."""
    out = Ordered(df, by, order, plain=plain).positions("__at", "__n", **whole)
    return out.withColumn("__i", F.col("__at") - 1).drop("__at")


def _share(n: Column, fraction: float) -> Column:
    return F.floor(n * F.lit(float(fraction))).cast("bigint")


def _kept(df: DataFrame, split: Column) -> DataFrame:
    out = df.withColumn("split", split).where(F.col("split").isNotNull())
    return out.drop("__i", "__n")


def split_rows(
    df: DataFrame,
    train: float = TRAIN,
    val: float = VAL,
    embargo: int = EMBARGO,
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Ratio split in time order with ``embargo`` rows left out between parts."""
    out = positions(df, by, order)
    i, n = F.col("__i"), F.col("__n")
    end, width = _share(n, train), _share(n, val)
    split = (
        F.when(i < end, "train")
        .when((i >= end + embargo) & (i < end + embargo + width), "val")
        .when(i >= end + 2 * embargo + width, "test")
    )
    return _kept(out, split)


def split_segments(
    df: DataFrame,
    train: float = TRAIN,
    val: float = VAL,
    embargo_s: float = EMBARGO,
    *,
    by: Sequence[str] = ("symbol",),
    segment: str = "segment_id",
    ts: str = "ts",
    order: Sequence[str] = (),
) -> DataFrame:
    """Ratio split of every segment; val and test keep rows more than ``embargo_s``
    seconds after the last row of the parts before them. ``order``: columns that put rows of
    equal time in order, without which either may come first."""
    gap = round(embargo_s * 1_000_000)
    at, n = micros(ts), F.col("__n")

    def part(i: Column) -> Column:
        end = _share(n, train)
        return F.when(i < end, "train").when(i < end + _share(n, val), "val").otherwise("test")

    def last(split: str) -> Column:
        return F.max(F.when(part(F.col("__at") - 1) == split, at))

    out = positions(df, [*by, segment], [ts, *order], __train=last("train"), __val=last("val"))
    out = out.withColumn("split", part(F.col("__i")))
    if gap:
        before_val = F.col("__train")
        # The last validation row survives its own embargo or none does.
        val_kept = F.when(before_val.isNull() | (F.col("__val") > before_val + gap), F.col("__val"))
        before_test = F.coalesce(val_kept, before_val)
        keep = (
            F.when(F.col("split") == "val", before_val.isNull() | (at > before_val + gap))
            .when(F.col("split") == "test", before_test.isNull() | (at > before_test + gap))
            .otherwise(True)
        )
        out = out.where(keep)
    return out.drop("__i", "__n", "__train", "__val")


def split_time(
    df: DataFrame,
    val: float = 0.2,
    *,
    by: Sequence[str] = (),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """The last ``max(1, floor(n * val))`` rows in time order are validation."""
    out = positions(df, by, order)
    n_val = F.greatest(F.lit(1), _share(F.col("__n"), val))
    return _kept(out, F.when(F.col("__i") < F.col("__n") - n_val, "train").otherwise("val"))


def split_three(
    df: DataFrame,
    val: float = 0.2,
    test: float = 0.1,
    embargo: int = EMBARGO,
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Train / val / test where the fractions name the later parts."""
    return split_rows(df, 1 - val - test, val, embargo, by=by, order=order)


def _unit(keys: Sequence[str], seed: int) -> Column:
    """A repeatable value in [0, 1) per key, the same under any partitioning and in any engine:
    the first 13 hexadecimal digits of the md5 of seed and keys, joined by ``|``."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / float(1 << 52)


def split_hash(df: DataFrame, keys: Sequence[str], val: float = 0.2, seed: int = 42) -> DataFrame:
    """Random split that depends on the row's key only."""
    return df.withColumn("split", F.when(_unit(keys, seed) < val, "val").otherwise("train"))


def sample_hash(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Random fraction of the rows that depends on the row's key only."""
    return df.where(_unit(keys, seed) < fraction)


def last_n(df: DataFrame, n: int, order: Sequence[str] = ("ts",)) -> DataFrame:
    """The last ``n`` rows in time over all series."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def systematic(
    df: DataFrame,
    max_rows: int,
    *,
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts",),
    plain: bool = False,
) -> DataFrame:
    """Every ``floor(n / max_rows)``-th row of each series in time order."""
    out = positions(df, by, order, plain=plain)
    step = F.greatest(F.lit(1), F.floor(F.col("__n") / max_rows))
    return out.where(F.col("__i") % step == 0).drop("__i", "__n")
