"""Rolling sums, means and deviations of many windows at once.

Spark evaluates a sliding frame by going over all of its rows again for every row:
some fifty statistics over windows up to 600 rows cost milliseconds per row. Here
Spark shuffles and sorts the series as for any window function, and the statistics
are made on the sorted Arrow batches, a few numpy additions each: sums over 2, 4,
8, .. rows are built from the next shorter ones, and a window is put together from
those. Nothing is ever subtracted, so a large value that has left the window leaves
no error behind. A task holds one batch and the last rows before it, whatever the
length of the series.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Windows up to this many rows stay with Spark's frames.
SHORT = 5

_POS = "__pos"


class Rolling:
    """Collects rolling statistics over one window spec, then adds them in one go.

    r = Rolling(spec)
    made = {"m": r.avg("x", 60)}          # a column that exists after attach
    r.attach(df).withColumns(made)        # r.detach drops the helper columns

    Values are NULL below ``min_periods`` non-NULL rows, by default the full window.
    Window functions needed beside it are best added to ``df`` before ``attach``:
    Spark does not know that its result is still sorted.
    """

    def __init__(self, spec: WindowSpec, min_periods: int | None = None) -> None:
        self.spec, self.min_periods = spec, min_periods
        self.series: dict[str, tuple[str, Column]] = {}
        self.wanted: dict[str, tuple[str, str, int, int]] = {}

    def sum(self, value: Column | str, size: int, back: int = 0) -> Column:
        """Over the ``size`` rows that end ``back`` rows earlier."""
        return self._want("sum", value, size, back)

    def avg(self, value: Column | str, size: int, back: int = 0) -> Column:
        return self._want("avg", value, size, back)

    def std(self, value: Column | str, size: int, back: int = 0) -> Column:
        return self._want("std", value, size, back)

    def _want(self, stat: str, value: Column | str, size: int, back: int) -> Column:
        column = F.col(value) if isinstance(value, str) else value
        name, _ = self.series.setdefault(str(column), (f"__x{len(self.series)}", column))
        out = f"__{stat}{size}_{back}{name}"
        self.wanted[out] = (stat, name, size, back)
        return F.col(out)

    def attach(self, df: DataFrame) -> DataFrame:
        columns = df.columns
        df = df.withColumns({n: c.cast("double") for n, c in self.series.values()})
        if max(size + back for _, _, size, back in self.wanted.values()) <= SHORT:
            return df.withColumns({o: self._framed(*w) for o, w in self.wanted.items()}).select(*columns, *self.wanted)
        # The row number also makes Spark bring the rows into order.
        df = df.withColumn(_POS, F.row_number().over(self.spec) - 1)
        fields = [df.schema[c] for c in columns] + [T.StructField(o, T.DoubleType()) for o in self.wanted]
        names = [n for n, _ in self.series.values()]
        return df.mapInArrow(_kernel(columns, names, dict(self.wanted), self.min_periods), T.StructType(fields))

    def detach(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.wanted)

    def _framed(self, stat: str, name: str, size: int, back: int) -> Column:
        agg = {"sum": F.sum, "avg": F.avg, "std": F.stddev_samp}[stat]
        frame = self.spec.rowsBetween(1 - size - back, -back)
        needed = size if self.min_periods is None else self.min_periods
        return F.when(F.count(name).over(frame) >= needed, agg(name).over(frame))


def rolling_table(series: dict, wanted: dict[str, tuple[str, str, int, int]], min_periods: int | None = None):
    """Statistics (statistic, series, rows, rows back) over one series held in memory: arrays of
    doubles by name, NULL as a masked value, in order. For state that a stream keeps."""
    import numpy as np
    import pyarrow as pa

    columns = {n: pa.array(np.ma.getdata(x), mask=np.ma.getmaskarray(x)) for n, x in series.items()}
    columns[_POS] = pa.array(np.arange(len(next(iter(series.values())))))
    batch = pa.RecordBatch.from_pydict(columns)
    return pa.Table.from_batches(list(_kernel(list(series), list(series), wanted, min_periods)(iter([batch]))))


def _kernel(
    columns: list[str], names: list[str], wanted: dict[str, tuple[str, str, int, int]], min_periods: int | None
) -> Callable[[Iterator], Iterator]:
    """Function over the sorted batches of a partition. It holds all it needs, so
    that workers do not import this package."""
    pos_name = _POS
    keep = max(size + back for _, _, size, back in wanted.values())
    sizes: dict[str, set[int]] = {}
    for _, name, size, _ in wanted.values():
        sizes.setdefault(name, set()).add(size)
    spread = {name for stat, name, _, _ in wanted.values() if stat == "std"}

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def earlier(x, k: int, pos):
            """Values ``k`` rows before, 0 where the series began later."""
            out = np.zeros_like(x)
            if k < len(x):
                out[k:] = x[: len(x) - k]
            out[pos < k] = 0
            return out

        def merge(a, b):
            """Count, sum and squared deviations of two stretches of rows."""
            n, s = a[0] + b[0], a[1] + b[1]
            if a[2] is None:
                return n, s, None
            both = (a[0] > 0) & (b[0] > 0)
            gap = np.divide(b[1], b[0], out=np.zeros_like(s), where=both)
            gap -= np.divide(a[1], a[0], out=np.zeros_like(s), where=both)
            weight = np.divide(a[0] * b[0], n, out=np.zeros_like(s), where=both)
            return n, s, a[2] + b[2] + gap * gap * weight

        def shifted(part, k: int, pos):
            return part if k == 0 else tuple(None if x is None else earlier(x, k, pos) for x in part)

        def windows(values, valid, pos, todo: set[int], with_spread: bool):
            """(count, sum, squared deviations) per window size."""
            block = (valid.astype("float64"), np.where(valid, values, 0.0), np.zeros(len(values)) if with_spread else None)
            parts, reach, length = {}, dict.fromkeys(todo, 0), 1
            while True:
                for w in todo:
                    if w & length:
                        piece = shifted(block, reach[w], pos)
                        parts[w] = merge(parts[w], piece) if w in parts else piece
                        reach[w] += length
                if max(todo) < 2 * length:
                    return parts
                block = merge(block, shifted(block, length, pos))
                length *= 2

        held = {name: (np.empty(0), np.empty(0, dtype=bool)) for name in names}
        held_pos = np.empty(0, dtype="int64")
        for batch in batches:
            rows = batch.num_rows
            if rows == 0:
                continue
            before = len(held_pos)
            pos = np.concatenate([held_pos, batch.column(pos_name).to_numpy(zero_copy_only=False).astype("int64")])
            parts = {}
            for name in names:
                column = batch.column(name)
                valid = np.concatenate([held[name][1], column.is_valid().to_numpy(zero_copy_only=False)])
                values = np.concatenate([held[name][0], column.to_numpy(zero_copy_only=False)])
                held[name] = (values[-keep:], valid[-keep:])
                parts[name] = windows(values, valid, pos, sizes[name], name in spread)
            held_pos = pos[-keep:]
            made = []
            for stat, name, size, back in wanted.values():
                n, s, q = shifted(parts[name][size], back, pos)
                need = max(size if min_periods is None else min_periods, 2 if stat == "std" else 1)
                known = n >= need
                if stat == "sum":
                    out = s
                elif stat == "avg":
                    out = np.divide(s, n, out=np.zeros_like(s), where=known)
                else:
                    out = np.sqrt(np.divide(q, n - 1, out=np.zeros_like(s), where=known))
                made.append(pa.array(out[before:], mask=~known[before:]))
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(kept + made, names=[*columns, *wanted])

    return run
