"""Exact deduplication with a two-pass Bloom filter.

The first pass counts, per filter position, whether no, one or several hashes fall on it. A
text can only occur twice if all its positions were hit several times, so in the second pass
the filter splits the rows: those that may be repeated are grouped and thereby shuffled, all
others pass straight through. The grouping decides, so a false hit of the filter costs a
shuffled row and never changes a result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.session import stage

# Positions a hash has in the filter, positions per expected row, and the most positions. The
# filter sent to the tasks takes one bit per position: 32 MiB at most, whatever the table.
# Beyond some 17 million rows it thus fills up: more rows are then grouped, none is missed.
HASHES = 4
PER_ROW = 16
MOST_POSITIONS = 1 << 28
LEAST_POSITIONS = 1 << 16
# The filter is built in chunks, each of which is one row of a grouped step.
CHUNK = 1 << 15
# Parts in which the rows of one repeated text are handled.
SALTS = 64

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_hash(text: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the text with A-Z lower-cased; null counts as empty."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    return F.sha2(F.encode(F.translate(body, UPPER, UPPER.lower()), "UTF-8"), 256)


def filter_size(rows: int) -> int:
    size = LEAST_POSITIONS
    while size < min(MOST_POSITIONS, rows * PER_ROW):
        size *= 2
    return size


def positions(hashes: list[str], size: int) -> np.ndarray:
    """Filter positions (row by hash function) of hexadecimal SHA-256 values."""
    raw = np.frombuffer(bytes.fromhex("".join(hashes)), dtype="<u8").reshape(-1, 4)
    a, b = raw[:, 0], raw[:, 1] | np.uint64(1)
    k = np.arange(HASHES, dtype=np.uint64)
    return ((a[:, None] + k * b[:, None]) >> np.uint64(20)) & np.uint64(size - 1)


def build_filter(hashes: DataFrame, column: str, size: int) -> np.ndarray:
    """Bits of the positions that were hit more than once, from a column of SHA-256 values."""

    def hits(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at = positions(batch.column(0).to_pylist(), size)
            at.sort(axis=1)  # a hash may have a position twice: count it once
            fresh = np.ones(at.shape, dtype=bool)
            fresh[:, 1:] = at[:, 1:] != at[:, :-1]
            place, count = np.unique(at[fresh], return_counts=True)
            chunk = (place // np.uint64(CHUNK)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1))
            inner = (place % np.uint64(CHUNK)).astype("<u2")
            many = (count > 1).astype(np.uint8)
            spans = list(zip(cuts[:-1], cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(chunk[i]) for i, _ in spans], pa.int64()),
                    pa.array([inner[i:j].tobytes() for i, j in spans], pa.binary()),
                    pa.array([np.packbits(many[i:j]).tobytes() for i, j in spans], pa.binary()),
                ],
                names=["chunk", "places", "many"],
            )

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(CHUNK, dtype=np.uint32)
        for places, many in zip(parts["places"], parts["many"]):
            at = np.frombuffer(places, dtype="<u2")
            seen[at] += 1 + np.unpackbits(np.frombuffer(many, dtype=np.uint8), count=len(at))
        bits = np.packbits(seen > 1).tobytes()
        return pd.DataFrame({"chunk": [key[0]], "bits": [bits]})

    parts = hashes.select(column).mapInArrow(hits, "chunk long, places binary, many binary")
    merged = parts.groupBy("chunk").applyInPandas(merge, "chunk long, bits binary")
    out = np.zeros(size // 8, dtype=np.uint8)
    for row in merged.toLocalIterator():  # chunks of a filter of bounded size
        start = row["chunk"] * CHUNK // 8
        out[start : start + CHUNK // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def maybe_repeated(df: DataFrame, column: str, bits: np.ndarray, out: str) -> DataFrame:
    """Add a boolean column: whether the SHA-256 in ``column`` may occur more than once."""
    size = len(bits) * 8
    shared = df.sparkSession.sparkContext.broadcast(bits)  # at most MOST_POSITIONS / 8 bytes

    @F.pandas_udf("boolean")
    def test(hashes: pd.Series) -> pd.Series:
        if not len(hashes):
            return pd.Series([], dtype=bool)
        at = positions(hashes.tolist(), size)
        hit = (shared.value[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1
        return pd.Series(hit.all(axis=1))

    return df.withColumn(out, test(column))


def exact_groups(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One narrow row per row: ``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal
    texts the row with the largest key stays; a null key is smaller than any other. Among rows
    that agree in key and text exactly one stays. Other columns, also of these names, are left
    aside; an empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("key"), text_hash(F.col(text)).alias("hash"))
    # Written once: the row numbers, and with them the choice among ties, then stay the same
    # however often a lost task is run again.
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()))
    bits = build_filter(rows, "hash", filter_size(rows.count()))
    split = stage(maybe_repeated(rows, "hash", bits, "again"))
    alone = split.filter(~F.col("again")).select(
        "key", F.col("key").alias("keep"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("stays"), "hash"
    )
    doubtful = split.filter("again")
    # A hot text's rows are summed up and told their group in parts, by a salt.
    doubtful = doubtful.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    parts = doubtful.groupBy("hash", "salt").agg(F.max(F.struct("key", "row")).alias("top"), F.count("*").alias("n"))
    groups = parts.groupBy("hash").agg(F.max("top").alias("top"), F.sum("n").alias("n"))
    groups = parts.select("hash", "salt").join(groups, "hash")
    found = doubtful.join(groups, ["hash", "salt"]).select(
        "key", F.col("top.key").alias("keep"), "n", (F.col("row") == F.col("top.row")).alias("stays"), "hash"
    )
    return alone.unionByName(found).select(
        F.col("key").alias(key),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("stays").alias("kept"),
        F.col("hash").alias("text_sha256"),
    )


def drop_exact(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns. Rows that cannot be repeated are filtered
    in place; only the others are shuffled. Among rows that agree in key and text any one
    stays."""
    hashed = df.withColumn("__hash", text_hash(F.col(text)))
    hashes = stage(df.select(text_hash(F.col(text)).alias("hash"), F.col(key).alias("key")))
    bits = build_filter(hashes, "hash", filter_size(hashes.count()))
    split = maybe_repeated(hashed, "__hash", bits, "__again")
    alone = split.filter(~F.col("__again")).drop("__hash", "__again")
    doubtful = maybe_repeated(hashes, "hash", bits, "again").filter("again")
    groups = doubtful.groupBy(F.col("hash").alias("__group")).agg(F.max("key").alias("__keep"))
    again = split.filter("__again")
    same = (F.col("__hash") == F.col("__group")) & F.col(key).eqNullSafe(F.col("__keep"))
    stays = again.join(groups, same, "left_semi").dropDuplicates(["__hash"])
    return alone.unionByName(stays.drop("__hash", "__again"))
