"""Exact quantiles with linear interpolation, by radix selection.

Doubles are read as 64-bit whole numbers that sort as they do. One pass counts the values of all
columns by their highest 16 bits; the buckets that hold a wanted position are refined by the
next bits, until few rows are left in them, which a last pass counts value by value. Nothing is
sampled or sorted, a task holds one count per bucket, and the same law gives the result of a
table of any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.session import stage

BITS = 16
# Buckets that together hold no more rows than this are resolved to single values at once.
FEW = 1 << 16


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], *, weight: str | None = None
) -> dict[str, list[float | None]]:
    """Quantiles per column, NULL and NaN left out. Comes back as plain numbers: one per column
    and probability, None for a column without values. ``weight`` names a whole-number column
    that says how often each row counts."""
    names = list(dict.fromkeys(columns))
    probs = [float(p) for p in probs]
    if any(not 0 <= p <= 1 for p in probs):
        raise ValueError("a probability lies between 0 and 1")
    # The values alone, written once: each pass reads them again.
    often = (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("often")
    values = stage(df.select(*[_clean(c).alias(f"c{i}") for i, c in enumerate(names)], often))
    shift, found = 64 - BITS, []
    while True:
        found = _buckets(values, len(names), shift, found, probs)
        if shift == 0 or not found:
            break
        left = sum({(b["column"], b["digit"]): b["n"] for b in found}.values())
        shift = 0 if left <= FEW else shift - BITS
    return {c: _interpolated([b for b in found if b["column"] == i], probs) for i, c in enumerate(names)}


def _clean(c: str) -> Column:
    value = F.col(c).cast("double")
    return F.when(~F.isnan(value), value)


def _buckets(values: DataFrame, width: int, shift: int, above: list, probs: list[float]) -> list:
    """Buckets (column, digit, before, n, total) that hold a wanted position, among the values
    below the buckets ``above``: the digit is a value's number without its last ``shift`` bits,
    before counts the smaller values. At most two rows per column and probability."""
    spark = values.sparkSession
    counted = values.mapInArrow(_count(width, shift, above), "column int, digit long, n long")
    counts = counted.groupBy("column", "digit").agg(F.sum("n").alias("n"))
    if above:
        # At most two rows per column and probability.
        parents = spark.createDataFrame(
            [(b["column"], b["digit"], b["before"], b["total"], b["shift"]) for b in above],
            "column int, parent long, offset long, total long, shift int",
        )
        parent = F.shiftright("digit", above[0]["shift"] - shift)
        counts = counts.withColumn("parent", parent).join(F.broadcast(parents), ["column", "parent"])
        within = Window.partitionBy("column", "parent")
    else:
        within = Window.partitionBy("column")
        counts = counts.withColumn("offset", F.lit(0).cast("long")).withColumn("total", F.sum("n").over(within))
    upto = F.sum("n").over(within.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.withColumn("before", F.col("offset") + upto - F.col("n"))
    places = [f(F.lit(p) * (F.col("total") - 1)) for p in probs for f in (F.floor, F.ceil)]
    inside = F.exists(F.array(*places), lambda x: (x >= F.col("before")) & (x < F.col("before") + F.col("n")))
    rows = counts.where(inside).select("column", "digit", "before", "n", "total").collect()
    return [{**r.asDict(), "shift": shift} for r in rows]


def _count(width: int, shift: int, above: list) -> Callable[[Iterator], Iterator]:
    """Function that counts the values of a task by column and digit."""
    wanted = [sorted({b["digit"] for b in above if b["column"] == i}) for i in range(width)]
    higher = above[0]["shift"] if above else None

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        seen: list[tuple] = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))] * width
        for batch in batches:
            often = batch.column(width).to_numpy(zero_copy_only=False)
            for i in range(width):
                known = batch.column(i).is_valid().to_numpy(zero_copy_only=False) & (often > 0)
                # Adding nothing turns -0.0 into 0.0.
                x = batch.column(i).fill_null(0.0).to_numpy(zero_copy_only=False)[known] + 0.0
                bits = x.view(np.int64)
                bits = np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)
                n = often[known]
                if higher is not None:
                    inside = np.isin(bits >> higher, wanted[i])
                    bits, n = bits[inside], n[inside]
                new, where = np.unique(np.concatenate([seen[i][0], bits >> shift]), return_inverse=True)
                total = np.zeros(len(new), dtype=np.int64)
                np.add.at(total, where, np.concatenate([seen[i][1], n]))
                seen[i] = (new, total)
        for i, (digit, n) in enumerate(seen):
            column = pa.array(np.full(len(digit), i), pa.int32())
            yield pa.RecordBatch.from_arrays([column, pa.array(digit), pa.array(n)], names=["column", "digit", "n"])

    return run


def _interpolated(buckets: list, probs: list[float]) -> list[float | None]:
    import numpy as np

    if not buckets:
        return [None] * len(probs)

    def value(position: int) -> float:
        digit = next(b["digit"] for b in buckets if b["before"] <= position < b["before"] + b["n"])
        bits = digit ^ (2**63 - 1) if digit < 0 else digit
        return float(np.array([bits], dtype=np.int64).view(np.float64)[0])

    out: list[float | None] = []
    for p in probs:
        at = p * (buckets[0]["total"] - 1)
        lo, hi, part = value(floor(at)), value(ceil(at)), at - floor(at)
        # Weighed this way an infinite neighbour gives an infinity, and not a number only
        # between the two infinities.
        out.append(lo if lo == hi or part == 0 else lo * (1 - part) + hi * part)
    return out


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(column, prob, value) rows."""
    found = exact_quantiles(df, columns, probs)
    rows = [(c, float(p), v) for c in columns for p, v in zip(probs, found[c])]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")
