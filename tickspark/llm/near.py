"""Near-duplicate detection on word shingles by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its
maximum, so a signature needs half the hash evaluations. Bands of signature values put alike
texts into common buckets; documents chained by buckets form families, and within a family
the full shingle sets decide which documents are linked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.arrays import distinct, hashed_words, mix, shingles, slices
from tickspark.llm.components import components
from tickspark.session import stage

SIZE = 5
BANDS = 43
# Bytes of text compared in one block; larger families are compared block against block.
BLOCK_BYTES = 8 << 20


def rows_per_band(percent: int) -> int:
    """Signature values per band, an even number. With 43 bands two sets that are just alike
    enough share none with a probability of about 1e-6 (85 %) or 2e-6 (80 %)."""
    return 8 if percent >= 85 else 6 if percent >= 80 else 4


def multipliers(count: int) -> np.ndarray:
    """Odd multipliers of the permutations h -> h * m (mod 2 ** 32); a fixed sequence."""
    return (mix(np.arange(1, count + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def band_keys(values: np.ndarray, bounds: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """Bucket keys (row by band) of non-empty sets of 64-bit hashes."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    at = bounds[:-1]
    out = np.zeros((len(at), bands), dtype=np.uint64)
    for band, own in enumerate(multipliers(bands * rows // 2).reshape(bands, -1)):
        total = np.full(len(at), band + 1, dtype=np.uint64)
        for m in own:
            turned = short * m
            low, high = np.minimum.reduceat(turned, at), np.maximum.reduceat(turned, at)
            total = mix(total + (low.astype(np.uint64) << np.uint64(32)) + high.astype(np.uint64))
        out[:, band] = total
    return out


def signatures(df: DataFrame, key: str, text: str, percent: int, row: str | None = None) -> DataFrame:
    """Per row: ``key``, its number of distinct shingles ``n``, its word sequence as two hashes
    ``p``, ``q``, its bucket keys ``bands`` (empty without words), and the row number ``row``
    if its column is given."""
    rows = rows_per_band(percent)
    numbers = [F.col(row).cast("long").alias("row")] if row else []

    def sign(batches):
        for whole in batches:
            for batch in slices(whole, 1):
                words, bounds = hashed_words(batch.column(1))
                sets, to = distinct(*shingles(words, bounds, SIZE))
                n = np.diff(to)
                full = n > 0
                keys = np.zeros((0, BANDS), dtype=np.uint64)
                if full.any():
                    keys = band_keys(sets, np.append(to[:-1][full], len(sets)), rows, BANDS)
                place = np.arange(len(words), dtype=np.uint64) - np.repeat(bounds[:-1], np.diff(bounds)).astype(np.uint64)
                sums = [np.zeros(len(words) + 1, dtype=np.uint64) for _ in range(2)]
                for i, out in enumerate(sums):
                    np.cumsum(mix(words + mix(place * np.uint64(2) + np.uint64(i + 1))), out=out[1:])
                p, q = (mix(s[bounds[1:]] - s[bounds[:-1]] + np.diff(bounds).astype(np.uint64)) for s in sums)
                ends = np.concatenate(([0], np.cumsum(full * BANDS))).astype(np.int32)
                bands = pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(n.astype(np.int64)),
                        pa.array(p.view(np.int64)),
                        pa.array(q.view(np.int64)),
                        bands,
                        *batch.columns[2:],
                    ],
                    names=["key", "n", "p", "q", "bands"] + ["row"] * len(batch.columns[2:]),
                )

    narrow = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"), *numbers)
    schema = "key long, n long, p long, q long, bands array<long>" + ", row long" * len(numbers)
    return narrow.mapInArrow(sign, schema)


def linked(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join all documents connected within these sets, at most one fewer than
    documents. ``side``: documents of different sides only are compared, 0 with all."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")  # sets of too different sizes cannot be alike
    sizes, side = sizes[order], side[order]
    names, ids = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    stops = np.searchsorted(sizes, sizes * 100 // percent, side="right")
    group = np.arange(len(sets))
    mark = np.zeros(len(names), dtype=np.int32)
    out = []
    for x in range(len(sets) - 1):
        lo, hi = x + 1, int(stops[x])
        open_ = group[lo:hi] != group[x]
        if side[x]:
            open_ &= side[lo:hi] != side[x]
        if not open_.any():
            continue
        own = ids[starts[x] : starts[x + 1]]
        mark[own] = 1
        common = np.add.reduceat(mark[ids[starts[lo] : starts[hi]]], starts[lo:hi] - starts[lo]).astype(np.int64)
        mark[own] = 0
        union = sizes[x] + sizes[lo:hi] - common
        for y in lo + np.flatnonzero(open_ & (100 * common >= percent * union)):
            if group[y] != group[x]:
                out.append((int(order[x]), int(order[y])))
                group[group == group[y]] = group[x]
    return out


def near_links(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) from members (tile, part, key, text): all rows of a tile are compared, or,
    where parts differ from 0, those of part 1 with those of part 2."""

    def flush(keys, parts, texts):
        words, bounds = hashed_words(pa.chunked_array(texts).combine_chunks())
        sets, to = distinct(*shingles(words, bounds, SIZE))
        found = linked([sets[i:j] for i, j in zip(to[:-1], to[1:])], np.array(parts), percent)
        return [(keys[x], keys[y]) for x, y in found]

    def compare(batches):
        tile, keys, parts, texts = None, [], [], []
        out: list[tuple[int, int]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.array(batch.column(0).to_pylist())
            cuts = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1], [True])))
            for i, j in zip(cuts[:-1], cuts[1:]):
                if names[i] != tile:
                    if len(keys) > 1:
                        out += flush(keys, parts, texts)
                    tile, keys, parts, texts = names[i], [], [], []
                run = batch.slice(i, j - i)
                keys += run.column(2).to_pylist()
                parts += run.column(1).to_pylist()
                texts.append(run.column(3).cast(pa.large_string()))
            if len(out) > 10_000:
                yield _pairs(out)
                out = []
        if len(keys) > 1:
            out += flush(keys, parts, texts)
        yield _pairs(out)

    # The order within a partition is part of the plan: rows of a tile come one after another.
    sorted_ = members.repartition("tile").sortWithinPartitions("tile").select("tile", "part", "key", "text")
    return sorted_.mapInArrow(compare, "a long, b long")


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])


def tiles(members: DataFrame) -> DataFrame:
    """Give members (family, key, text) their tiles. A family of up to ``BLOCK_BYTES`` of text
    is one tile. A larger one is dealt over blocks of that size by a hash, and every two blocks
    make a tile, so that all its pairs are compared in tasks of bounded size."""
    size = members.groupBy("family").agg(F.sum(F.octet_length("text")).alias("bytes"))
    size = size.select("family", F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("key"), F.greatest(F.col("blocks"), F.lit(1))).cast("int")
    placed = members.join(size, "family").withColumn("block", block)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    every = F.sequence(F.lit(0), F.greatest(F.col("blocks") - 1, F.lit(0)))
    placed = placed.withColumn("other", F.explode(every))
    part = F.when(low == high, 0).when(F.col("block") == low, 1).otherwise(2)
    return placed.select(
        F.concat_ws("/", "family", low, high).alias("tile"), part.cast("int").alias("part"), "key", "text"
    )


def near_duplicates(df: DataFrame, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One narrow row per row: ``key``, ``n_shingles``, ``component_id``, ``kept``.

    Words are runs of bytes other than white space, A-Z lower-cased; a set holds the distinct
    5-word shingles, or the whole sequence of fewer words. Two documents are linked if 100
    times their intersection is at least ``percent`` times their union. ``component_id`` is the
    smallest key reachable over links, ``kept`` whether it is the row's own. Without words a
    document is linked with nothing. A null key takes no part in choosing the smallest: such a
    row has its component's id, and null, and is kept, if there is none. Repeated rows have
    equal results. Different texts under one key are compared as texts of their own. Other
    columns are left aside; an empty table gives no rows.

    Equal word sequences are one node, whose key is the smallest. Buckets chain nodes into
    families; only texts of families of two or more nodes are read again and compared.
    """
    signed = stage(signatures(df, key, text, percent))
    named = linked_classes(df, signed, percent, text, key)
    ids = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(ids, "root").select(F.col("p").alias("_p"), F.col("q").alias("_q"), "component_id")
    own = (F.col("p") == F.col("_p")) & (F.col("q") == F.col("_q")) & (F.col("n") > 0)
    out = signed.select("key", "n", "p", "q").join(named, own, "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return out.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (component.isNull() | component.eqNullSafe(F.col("key"))).alias("kept"),
    )


def linked_classes(df: DataFrame, signed: DataFrame, percent: int, text: str, key: str) -> DataFrame:
    """One row per word sequence of ``signed``: its hashes ``p``, ``q``, its smallest key
    ``rep``, and ``root``, the same for all sequences of a component. If the rows are numbered
    also ``lead``, its row of the smallest key, null keys last."""
    # A word sequence is one class. Classes whose keys are all null get a number below all keys.
    made = [F.min("key").alias("rep"), F.first("bands").alias("bands")]
    lead = ["lead"] if "row" in signed.columns else []
    if lead:
        made.append(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("lead"))
    classes = signed.filter("n > 0").groupBy("p", "q").agg(*made)
    node = F.xxhash64("p", "q")
    classes = stage(classes.select("p", "q", "rep", node.alias("node"), "bands", *lead))
    buckets = classes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    edges = buckets.join(shared.filter("least < most"), "bucket").filter("node > least")
    families = components(edges.select(F.col("node").alias("a"), F.col("least").alias("b")))
    # One text per node: rows of a class have the same words, the first row found will do.
    inside = families.join(classes.select("node", "p", "q", "rep"), "node")
    inside = inside.select(F.col("root").alias("family"), "node", "rep", "p", "q")
    # Texts are fetched by key; the two hashes pick the right one if a key has several.
    fetched = fetch(df, inside, signed, text, key)
    links = near_links(tiles(fetched), percent)
    roots = components(links)
    named = classes.select("node", "p", "q", "rep", *lead).join(roots, "node", "left")
    return named.select("p", "q", "rep", F.coalesce("root", "node").alias("root"), *lead)


def fetch(df: DataFrame, inside: DataFrame, signed: DataFrame, text: str, key: str) -> DataFrame:
    """(family, key, text) with the node as key, one row per node of ``inside``."""
    texts = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    named = inside.filter("rep IS NOT NULL")
    found = texts.join(named.select("family", "node", F.col("rep").alias("key")), "key")
    rest = inside.filter("rep IS NULL")
    if rest.limit(1).count():
        by_hash = signatures_of(texts.filter("key IS NULL"))
        found = found.unionByName(by_hash.join(rest, ["p", "q"]).select("key", "text", "family", "node"))
    # Under one key there may be several texts or repeated rows: keep the node's own, once.
    counted = named.groupBy("rep").count().filter("count > 1").limit(1).count()
    repeated = signed.groupBy("key").count().filter("count > 1").limit(1).count()
    if counted or repeated:
        exact = signatures_of(texts).withColumnRenamed("text", "body")
        found = exact.join(inside.select("p", "q", "family", "node"), ["p", "q"])
        found = found.groupBy("family", "node").agg(F.min("body").alias("text"))
    return found.select("family", F.col("node").alias("key"), "text")


def signatures_of(texts: DataFrame) -> DataFrame:
    """(key, text, p, q): rows with the hashes of their word sequence."""

    def sign(batches):
        for whole in batches:
            for batch in slices(whole, 1):
                words, bounds = hashed_words(batch.column(1))
                place = np.arange(len(words), dtype=np.uint64) - np.repeat(bounds[:-1], np.diff(bounds)).astype(np.uint64)
                cols = []
                for i in range(2):
                    total = np.zeros(len(words) + 1, dtype=np.uint64)
                    np.cumsum(mix(words + mix(place * np.uint64(2) + np.uint64(i + 1))), out=total[1:])
                    cols.append(mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *(pa.array(c.view(np.int64)) for c in cols)],
                    names=["key", "text", "p", "q"],
                )

    return texts.select("key", "text").mapInArrow(sign, "key long, text string, p long, q long")


def drop_near(df: DataFrame, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns: of each component exactly one row, that of
    the smallest key, null keys last; among rows of that key any one. Texts decide, so a row
    stays whatever becomes of other texts under its key. Rows without words all stay."""
    # Written once, so that the row numbers are the same however often they are read.
    rows = stage(df.withColumn("__row", F.monotonically_increasing_id()))
    signed = stage(signatures(rows, key, text, percent, "__row"))
    named = linked_classes(rows, signed, percent, text, key)
    stays = named.groupBy("root").agg(F.min("lead").alias("lead")).select(F.col("lead.row").alias("row"))
    gone = signed.filter("n > 0").select("row").join(stays, "row", "left_anti").withColumnRenamed("row", "__gone")
    return rows.join(gone, F.col("__row") == F.col("__gone"), "left_anti").drop("__row")
