"""Nearest neighbours by a block matrix join on quantised tiles with error bounds."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.session import stage

# Queries and candidates that one group holds, and candidates of one tile within it.
QUERY_ROWS = 1024
CANDIDATE_ROWS = 8192
TILE_ROWS = 2048


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values of each row, their scale, the norm of what they stand for, and the norm of
    the rounding error."""
    scale = np.maximum(np.abs(x).max(axis=1), np.finfo(np.float64).tiny) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed from the first component on."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def tile_search(qrow, q, crow, cid, c, k: int) -> list[list[tuple[float, int]]]:
    """For each query the heap of its k best (score, -id) among the candidates, its own row
    left out.

    A tile's int8 products are exact integers; scaled, they miss the true inner product by at
    most |x'||dy| + |dx||y|, where x' is the quantised query and dx, dy are rounding errors.
    Only candidates whose upper bound reaches the k-th best lower bound (or the heap's k-th
    score) are computed from the original components.
    """
    q8, qs, qn, qe = quantise(q)
    # float holds int8 products exactly up to 1040 components, double always.
    kind = np.float32 if q.shape[1] <= 1024 else np.float64
    left = q8.astype(kind)
    heaps: list[list[tuple[float, int]]] = [[] for _ in qrow]
    floor = np.full(len(qrow), -np.inf)
    for at in range(0, len(cid), TILE_ROWS):
        part, ids = c[at : at + TILE_ROWS], cid[at : at + TILE_ROWS]
        other = qrow[:, None] != crow[None, at : at + TILE_ROWS]
        c8, cs, cn, ce = quantise(part)
        about = (left @ c8.astype(kind).T).astype(np.float64) * qs[:, None] * cs[None, :]
        error = qn[:, None] * ce[None, :] + qe[:, None] * (cn + ce)[None, :]
        error = error * (1 + 1e-6) + 1e-9 * qn[:, None] * cn[None, :]  # rounding of these sums themselves
        low = np.where(other, about - error, -np.inf)
        if len(ids) > k:
            bound = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            bound = np.full(len(qrow), -np.inf)
        bound = np.maximum(bound, floor)
        i, j = np.nonzero((about + error >= bound[:, None]) & other)
        exact = inner(q[i], part[j])
        for row, score, name in zip(i.tolist(), exact.tolist(), ids[j].tolist()):
            heap, item = heaps[row], (score, -name)
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
        floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    return heaps


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part: those with an id and a vector that is not null, empty
    or zero and holds no null or non-finite component."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0))


def nearest(
    df: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The k candidates of largest inner product for each query: ``query_id``, ``rank`` from 1,
    ``vec_id``, ``score``. Queries are the rows whose key is divisible by ``every``,
    candidates all rows but the query's own, of the same number of components. Ties go to the
    smaller key. Rows that repeat a key are vectors of their own: each of them is found, and
    each is a query with ranks of its own. A query without candidates, and an empty table, give
    no rows; extra columns are left aside.

    The result is exact: bounds only decide what has to be computed. Query blocks meet
    candidate blocks in a grid of groups of bounded size, dealt by hash, and each group keeps
    k heaps' worth of pairs per query.
    """
    if k < 1 or every < 1:
        raise ValueError("k and every have to be positive")
    # Written once with numbers, which tell rows apart and stay the same when a task runs again.
    rows = stage(usable(df, key, vector).withColumn("row", F.monotonically_increasing_id()))
    sizes = rows.agg(F.count("*"), F.count(F.when(F.col("id") % every == 0, 1))).first()
    down = max(1, -(-sizes[1] // QUERY_ROWS))
    across = max(1, -(-sizes[0] // CANDIDATE_ROWS))
    spread = F.xxhash64("row")
    rows = rows.withColumn("dim", F.size("v"))
    v = F.col("v").cast("array<double>").alias("v")

    def every_of(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    queries = rows.filter(F.col("id") % every == 0).select(
        "dim", F.pmod(spread, F.lit(down)).cast("int").alias("r"), every_of(across).alias("c"), "id", "row", v
    )
    candidates = rows.select(
        "dim", every_of(down).alias("r"), F.pmod(spread, F.lit(across)).cast("int").alias("c"), "id", "row", v
    )

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, numbers = table.column("id").to_numpy(), table.column("row").to_numpy()
        flat = table.column("v").combine_chunks()
        flat = (pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat).flatten().to_numpy()
        return ids, numbers, flat.reshape(len(ids), -1)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, float]] = []
        if left.num_rows and right.num_rows:
            (qid, qrow, q), (cid, crow, c) = matrix(left), matrix(right)
            for name, number, heap in zip(qid.tolist(), qrow.tolist(), tile_search(qrow, q, crow, cid, c, k)):
                out += [(name, number, -other, score) for score, other in heap]
        columns = list(zip(*out)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        names = ("query_id", "query_row", "vec_id", "score")
        return pa.table({n: pa.array(x, t) for n, x, t in zip(names, columns, kinds)})

    grid_keys = ["dim", "r", "c"]
    found = queries.groupBy(*grid_keys).cogroup(candidates.groupBy(*grid_keys))
    found = found.applyInArrow(search, "query_id long, query_row long, vec_id long, score double")
    # Merging the groups' heaps: Spark keeps k rows per query before and after the shuffle.
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
