"""Ordered work inside a key, without one task per key.

Rolling frames, lags, as-of joins, running sums and row numbers all need the rows
of a key in order. A plain ``Window.partitionBy(key)`` hands every row of a key to
one task, which fails once a single symbol holds a third of the table. ``Ordered``
keeps the plain window for keys that fit a task and cuts the others into
contiguous *ranges* of their sort order:

1. count rows per key (pre-aggregated before the shuffle);
2. for keys above the limit only, sample sort keys as cell boundaries and count
   every cell exactly. The sample decides balance, never results;
3. give each row its range by binary search of the boundaries, whose number is
   limited by ``MAX_CELLS`` whatever the table size. The search is vectorised over
   Arrow batches of the sort columns; a join that carries the boundaries of a key as
   an array would copy that array into every row.

Row frames copy the cells that hold the neighbouring rows into the next range
(the exact counts say which), so one shuffle by (key, range) is enough. Unbounded
frames add one carried value per range. Ties need the order columns to be unique
within a key for a reproducible order, as with any window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickspark.session import chunk_rows, stage

CELLS_PER_RANGE = 8
MAX_CELLS = 1 << 18

_RANGE, _CELL, _OWN, _KEY = "__range", "__cell", "__own", "__key"
_COPIES, _PLACE, _START, _TOTAL = "__copies", "__place", "__start", "__total"


@dataclass(frozen=True)
class _Cells:
    """Exact cell counts of one oversized key, grouped into ranges."""

    key: tuple
    counts: list[int]
    limit: int

    @property
    def starts(self) -> list[int]:
        out, total = [], 0
        for n in self.counts:
            out.append(total)
            total += n
        return out

    @property
    def range_of(self) -> list[int]:
        out, rng, filled = [], 0, 0
        for n in self.counts:
            if filled and filled + n > self.limit:
                rng, filled = rng + 1, 0
            out.append(rng)
            filled += n
        return out

    def copies(self, back: int, forward: int) -> list[list[int]]:
        """Ranges that must see each cell so that frames of ``back`` earlier and
        ``forward`` later rows are complete for the rows a range owns."""
        starts, owner = self.starts, self.range_of
        first = {}
        last = {}
        for cell, rng in enumerate(owner):
            first.setdefault(rng, starts[cell])
            last[rng] = starts[cell] + self.counts[cell]
        n_ranges = owner[-1] + 1
        out = []
        for cell, rng in enumerate(owner):
            targets = [rng]
            nxt = rng + 1
            while nxt < n_ranges and first[nxt] - (starts[cell] + self.counts[cell]) < back:
                targets.append(nxt)
                nxt += 1
            prev = rng - 1
            while prev >= 0 and starts[cell] - last[prev] < forward:
                targets.append(prev)
                prev -= 1
            out.append(targets)
        return out


class Ordered:
    """A frame with an order inside each key.

    keys   -- columns that separate the series (may be empty: one global order)
    order  -- sort columns, unique within a key, compared ascending
    plain  -- the frame is a table scan, so reading it again costs no recomputation;
              otherwise it is written to the staging folder before being cut
    at_most -- a cheaper frame with at least as many rows per key, such as the ticks
              behind bars: while it fits, the frame itself need not be counted
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        *,
        plain: bool = False,
        limit: int | None = None,
        at_most: DataFrame | None = None,
    ) -> None:
        self.spark = df.sparkSession
        self.df, self.keys, self.order = df, list(keys), list(order)
        self.cells: list[_Cells] = []
        wanted = limit or chunk_rows(self.spark)
        if at_most is not None and self._sizes(at_most)[1] <= wanted:
            return
        if at_most is not None and not plain:
            self.df, plain = stage(df), True
        total, largest = self._sizes(self.df)
        if largest <= wanted:
            return
        self.limit = max(wanted, ceil(total * CELLS_PER_RANGE / MAX_CELLS))
        if not plain:
            self.df = stage(df)
        self._cut(self._per_key(self.df).where(F.col("n") > self.limit))

    # -- planning ---------------------------------------------------------------

    def _per_key(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"))

    def _sizes(self, df: DataFrame) -> tuple[int, int]:
        """Rows in all and in the largest key."""
        total, largest = self._per_key(df).agg(F.sum("n"), F.max("n")).first()
        return total or 0, largest or 0

    def _same_key(self, left: DataFrame, right: DataFrame) -> Column:
        cond = F.lit(True)
        for k in self.keys:
            cond = cond & left[k].eqNullSafe(right[f"__k_{k}"])
        return cond

    def _as_side(self, df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({k: f"__k_{k}" for k in self.keys})

    def _attach(self, df: DataFrame, side: DataFrame) -> DataFrame:
        """Left-join a small per-key table; its size is limited by MAX_CELLS."""
        if not self.keys:
            return df.withColumns({c: side.select(c).scalar() for c in side.columns})
        side = self._as_side(side)
        joined = df.join(F.broadcast(side), self._same_key(df, side), "left")
        return joined.drop(*[f"__k_{k}" for k in self.keys])

    def _cut(self, hot: DataFrame) -> None:
        fraction = min(1.0, CELLS_PER_RANGE / self.limit)
        sampled = self.df.select(*self.keys, *self.order).sample(fraction=fraction, seed=7)
        if self.keys:
            # Every oversized key fills at least one range, so there are few of them.
            side = self._as_side(hot.select(*self.keys))
            sampled = sampled.join(F.broadcast(side), self._same_key(sampled, side), "left_semi")
        elif hot.isEmpty():
            return
        # About MAX_CELLS boundaries at most, over all keys.
        bounds = sampled.distinct().orderBy(*self.keys, *self.order).toArrow()
        keys = list(zip(*[bounds.column(k).to_pylist() for k in self.keys])) or [()] * bounds.num_rows
        firsts = [i for i, k in enumerate(keys) if i == 0 or k != keys[i - 1]]
        if not firsts:
            return
        self._edges = [*firsts, bounds.num_rows]
        self._columns = [_sortable(bounds.column(c).combine_chunks()) for c in self.order]
        if self.keys:
            found = bounds.select(self.keys).take(firsts)
            found = found.append_column(_KEY, [list(range(len(firsts)))])
            self._key_ids = self.spark.createDataFrame(found).withColumn(_KEY, F.col(_KEY).cast("int"))
        counted = (
            self._with_cell(self.df.select(*self.keys, *self.order))
            .where(F.col(_KEY).isNotNull())
            .groupBy(_KEY, _CELL)
            .agg(F.count(F.lit(1)).alias("n"))
        )
        counts = [[0] * (b - a + 1) for a, b in zip(self._edges, self._edges[1:])]
        for row in counted.collect():
            counts[row[_KEY]][row[_CELL]] = row["n"]
        self.cells = [_Cells(keys[at], c, self.limit) for at, c in zip(firsts, counts)]

    def _with_key(self, df: DataFrame) -> DataFrame:
        """Number of the oversized key, NULL for a small one."""
        if not self.keys:
            return df.withColumn(_KEY, F.lit(0))
        return self._attach(df, self._key_ids)

    def _with_cell(self, df: DataFrame) -> DataFrame:
        """Cell number in the key, NULL for small keys."""
        cell = F.arrow_udf(_search(self._edges, self._columns), "int")
        return self._with_key(df).withColumn(_CELL, cell(F.col(_KEY), *[F.col(c) for c in self.order]))

    def _looked_up(self, df: DataFrame, name: str, table, kind: str) -> DataFrame:
        """Add the entry of ``table`` for the cell of each row. The table lists all
        cells of all keys and ends with the entry of small keys."""
        find = _search(self._edges, self._columns, table)
        value = F.arrow_udf(find, kind)(F.col(_KEY), *[F.col(c) for c in self.order])
        return self._with_key(df).withColumn(name, value).drop(_KEY)

    def ranges(self) -> DataFrame:
        """(keys, range) of every oversized key, at most MAX_CELLS rows."""
        key_type = self.df.select(*self.keys).schema
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key_type)
        rows = [(*c.key, r) for c in self.cells for r in range(c.range_of[-1] + 1)]
        return self.spark.createDataFrame(rows, f"{fields}, {_RANGE} int" if fields else f"{_RANGE} int")

    # -- assignment -------------------------------------------------------------

    @property
    def is_cut(self) -> bool:
        return bool(self.cells)

    def assigned(self) -> DataFrame:
        """The frame with its range, the rows before that range and, for oversized
        keys, the rows of the key. Small keys are range 0."""
        place = []
        for c in self.cells:
            first: dict[int, int] = {}
            for start, rng in zip(c.starts, c.range_of):
                first.setdefault(rng, start)
            total = sum(c.counts)
            place += [{"r": r, "s": first[r], "t": total} for r in c.range_of]
        place.append({"r": 0, "s": 0, "t": None})
        table = pa.array(place, pa.struct({"r": pa.int32(), "s": pa.int64(), "t": pa.int64()}))
        out = self._looked_up(self.df, _PLACE, table, "struct<r: int, s: bigint, t: bigint>")
        at = F.col(_PLACE)
        return out.withColumns({_RANGE: at["r"], _START: at["s"], _TOTAL: at["t"]}).drop(_PLACE)

    def _with_copies(self, back: int, forward: int) -> DataFrame:
        copies = [ranges for c in self.cells for ranges in c.copies(back, forward)]
        table = pa.array([*copies, [0]], pa.list_(pa.int32()))
        out = self._looked_up(self.df, _COPIES, table, "array<int>")
        # The first entry is the range that owns the row.
        out = out.withColumn(_OWN, F.get(_COPIES, F.lit(0))).withColumn(_RANGE, F.explode(_COPIES))
        return out.withColumn(_OWN, F.col(_RANGE) == F.col(_OWN)).drop(_COPIES)

    # -- operators --------------------------------------------------------------

    def windows(
        self,
        add: Callable[[DataFrame, WindowSpec], DataFrame],
        *,
        back: int = 0,
        forward: int = 0,
        within: Sequence[str] = (),
    ) -> DataFrame:
        """Run ``add(df, window)`` for frames reaching ``back`` rows behind and
        ``forward`` rows ahead. ``within`` lists extra columns whose values are
        contiguous in the order (segments), which frames must not cross."""
        if not self.is_cut:
            return add(self.df, Window.partitionBy(*self.keys, *within).orderBy(*self.order))
        spec = Window.partitionBy(*self.keys, _RANGE, *within).orderBy(*self.order)
        out = add(self._with_copies(back, forward), spec)
        return out.where(_OWN).drop(_RANGE, _OWN)

    def row_number(self, name: str = "row_number") -> DataFrame:
        """Exact 1-based position inside the key."""
        return self.positions(name, "__size").drop("__size")

    def positions(self, number: str, size: str, **whole: Column) -> DataFrame:
        """1-based position in the key and rows of the key. ``whole`` adds aggregates
        over the whole key, which may use both."""
        if not self.is_cut:
            w = Window.partitionBy(*self.keys)
            at, n = F.row_number().over(w.orderBy(*self.order)), F.count(F.lit(1)).over(w)
            out = self.df.withColumns({number: at.cast("bigint"), size: n})
            return out.withColumns({name: agg.over(w) for name, agg in whole.items()})
        w = Window.partitionBy(*self.keys, _RANGE)
        at = F.row_number().over(w.orderBy(*self.order)) + F.col(_START)
        n = F.coalesce(F.col(_TOTAL), F.count(F.lit(1)).over(w))
        out = self.assigned().withColumns({number: at, size: n})
        if whole:
            # One row per oversized key; a small key lies in one range.
            cut = out.where(F.col(_TOTAL).isNotNull()).groupBy(*self.keys)
            side = cut.agg(*[agg.alias(f"__all_{name}") for name, agg in whole.items()])
            out = self._attach(out, side)
            cut_key = F.col(_TOTAL).isNotNull()
            out = out.withColumns(
                {n: F.when(cut_key, F.col(f"__all_{n}")).otherwise(agg.over(w)) for n, agg in whole.items()}
            )
        return out.drop(_RANGE, _START, _TOTAL, *[f"__all_{n}" for n in whole])

    def running_sum(self, **sums: Column) -> DataFrame:
        """Running totals up to and including each row; NULL counts as 0."""
        if not self.is_cut:
            w = Window.partitionBy(*self.keys).orderBy(*self.order)
            w = w.rowsBetween(Window.unboundedPreceding, 0)
            return self.df.withColumns({n: F.coalesce(F.sum(c).over(w), F.lit(0)) for n, c in sums.items()})
        spec = Window.partitionBy(*self.keys, _RANGE).orderBy(*self.order)
        spec = spec.rowsBetween(Window.unboundedPreceding, 0)
        base = self.assigned().drop(_START, _TOTAL)
        per_range = base.groupBy(*self.keys, _RANGE).agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(f"__carry_{n}") for n, c in sums.items()]
        )
        before = Window.partitionBy(*self.keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
        carry = self._per_range(per_range).withColumns(
            {f"__carry_{n}": F.sum(f"__carry_{n}").over(before) for n in sums}
        )
        out = self._range_join(base, carry)
        out = out.withColumns(
            {
                n: F.coalesce(F.sum(c).over(spec), F.lit(0)) + F.coalesce(F.col(f"__carry_{n}"), F.lit(0))
                for n, c in sums.items()
            }
        )
        return out.drop(_RANGE, *[f"__carry_{n}" for n in sums])

    def last_known(self, *, ahead: bool = False, **values: Column) -> DataFrame:
        """Latest non-NULL value at or before each row (``ahead``: at or after).

        Ahead means back in the reversed order: Spark keeps a frame that begins at the first
        row as it goes on, but goes through one that ends at the last row again for every row.
        """
        turn = F.desc if ahead else F.asc

        def latest(c: Column | str, spec: WindowSpec, end: int = 0) -> Column:
            return F.last(c, ignorenulls=True).over(spec.rowsBetween(Window.unboundedPreceding, end))

        order = [turn(c) for c in self.order]
        if not self.is_cut:
            w = Window.partitionBy(*self.keys).orderBy(*order)
            return self.df.withColumns({n: latest(c, w) for n, c in values.items()})
        spec = Window.partitionBy(*self.keys, _RANGE).orderBy(*order)
        base = self.assigned().drop(_START, _TOTAL)
        edge = F.min_by if ahead else F.max_by
        here = F.struct(*self.order)
        per_range = base.groupBy(*self.keys, _RANGE).agg(
            *[
                edge(c, F.when(c.isNotNull(), here)).alias(f"__carry_{n}")
                for n, c in values.items()
            ]
        )
        across = Window.partitionBy(*self.keys).orderBy(turn(_RANGE))
        carry = self._per_range(per_range).withColumns(
            {f"__carry_{n}": latest(f"__carry_{n}", across, -1) for n in values}
        )
        out = self._range_join(base, carry)
        out = out.withColumns(
            {
                n: F.coalesce(latest(c, spec), F.col(f"__carry_{n}"))
                for n, c in values.items()
            }
        )
        return out.drop(_RANGE, *[f"__carry_{n}" for n in values])

    # -- range tables -----------------------------------------------------------

    def _per_range(self, per_range: DataFrame) -> DataFrame:
        """One row for every range of an oversized key, empty ones included."""
        return self._range_join(self.ranges(), per_range)

    def _range_join(self, left: DataFrame, right: DataFrame) -> DataFrame:
        right = self._as_side(right).withColumnRenamed(_RANGE, "__k_range")
        cond = self._same_key(left, right) & (left[_RANGE] == right["__k_range"])
        # Limited by MAX_CELLS rows: one per range.
        return left.join(F.broadcast(right), cond, "left").drop("__k_range", *[f"__k_{k}" for k in self.keys])


def _make_sortable() -> Callable:
    # Made inside a function so that it travels to the workers by value.
    def sortable(column):
        """Validity and values that compare like Spark's ascending order: NULL first,
        NaN last, -0.0 equal to 0.0."""
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        kind = column.type
        if pa.types.is_floating(kind):
            x = column.fill_null(0).to_numpy(zero_copy_only=False).astype("float64") + 0.0
            x[np.isnan(x)] = np.nan
            bits = x.view("int64")
            return valid, bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))
        if pa.types.is_date32(kind):
            column, kind = column.cast(pa.int32()), pa.int32()
        if pa.types.is_integer(kind) or pa.types.is_timestamp(kind) or pa.types.is_boolean(kind):
            return valid, column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
        if pa.types.is_string(kind) or pa.types.is_large_string(kind) or pa.types.is_binary(kind):
            empty = b"" if pa.types.is_binary(kind) else ""
            return valid, np.array(column.fill_null(empty).to_pylist(), dtype=object)
        raise TypeError(f"cannot order by {kind}")

    return sortable


_sortable = _make_sortable()


def _search(edges: list[int], columns: list[tuple[np.ndarray, np.ndarray]], table: pa.Array | None = None):
    """Arrow function (key number, sort columns) -> number of boundaries of the key at
    or below the row, or the table entry of that cell. It carries its helpers along,
    so that workers do not import this package."""
    first, last = np.array(edges[:-1]), np.array(edges[1:])
    sortable = _sortable

    def find(key, *order):
        known = key.is_valid().to_numpy(zero_copy_only=False)
        number = key.fill_null(0).to_numpy(zero_copy_only=False)
        rows = [sortable(c) for c in order]
        low, high = first[number].copy(), last[number].copy()
        while (open_ := low < high).any():
            middle = np.minimum((low + high) // 2, len(columns[0][0]) - 1)
            below = np.ones(len(low), dtype=bool)
            for (b_valid, b), (r_valid, r) in zip(reversed(columns), reversed(rows)):
                bv, x = b_valid[middle], b[middle]
                same = bv == r_valid
                less = np.where(same, x < r, bv < r_valid)
                below = less.astype(bool) | (same & (x == r) & below)
            low = np.where(open_ & below, middle + 1, low)
            high = np.where(open_ & ~below, middle, high)
        cell = low - first[number]
        if table is None:
            return pa.array(cell.astype("int32"), mask=~known)
        # Each key has one more cell than boundaries.
        entry = np.where(known, low + number, len(table) - 1)
        return table.take(pa.array(entry))

    return find
