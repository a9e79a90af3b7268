"""Gapless numbers within groups of any size, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.session import stage

# Digits of md5 read as a number: 13 hexadecimal ones, so below 2 ** 52.
HASH_SPACE = 1 << 52
ROWS_PER_CELL = 50_000
LEAST_CELLS = 256
# Bits of a row's number within its partition, as monotonically_increasing_id packs them.
_ROW_BITS = 33


def hash52(text: Column) -> Column:
    """The first 13 hexadecimal digits of the md5 as a number; any engine can repeat it."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def number(df: DataFrame, group: str, spread: str, order: list[str], out: str, rows: int) -> DataFrame:
    """Number the rows of each ``group`` from 0 in the order of ``spread`` (from ``hash52``),
    then of ``order``. ``rows`` is the frame's row count.

    The hash space is cut into cells of about ``ROWS_PER_CELL`` rows; a row's number is its
    number in its cell plus the rows of the group's earlier cells. A group that holds a third
    of all rows is therefore numbered by many tasks. Rows equal in all of these columns are
    numbered in any order among themselves.
    """
    cells = max(LEAST_CELLS, -(-rows // ROWS_PER_CELL))
    cell = F.floor(F.col(spread) / F.lit(HASH_SPACE / cells)).cast("bigint")
    df = df.withColumn("_cell", cell)
    counts = df.groupBy(group, "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col(group).alias("_group"),
        F.col("_cell").alias("_at"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(group, "_cell").orderBy(spread, *order)
    df = df.withColumn("_row", F.row_number().over(inside))
    joined = df.join(counts, (F.col(group) == F.col("_group")) & (F.col("_cell") == F.col("_at")))
    number = (F.col("_before") + F.col("_row") - 1).cast("bigint")
    return joined.withColumn(out, number).drop("_cell", "_row", "_group", "_at", "_before")


def in_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``i``, the place of a row within its ``tree`` in the given order, and ``n``, the
    tree's number of rows. Rows are cut into ranges of (tree, order), so a tree of any size is
    sorted by many tasks; equal rows have to differ in a last column of ``order`` to be parted.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = stage(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS).alias("_part")
    ranged = ranged.select("*", part, F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"))
    spans = ranged.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    spans = spans.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("n"),
    )
    numbered = ranged.join(spans, ["tree", "_part"])
    return numbered.withColumn("i", F.col("_row") + F.col("_shift")).drop("_at", "_part", "_row", "_shift")
