"""Sharding by rendezvous hashing over weighted shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.numbering import HASH_SPACE, hash52, number


def rendezvous(key: Column, weights: dict[int, float]) -> Column:
    """The shard with the highest score for a key, where the score of a shard of weight w is
    -w / ln(u) and u in (0, 1) is the hash of key and shard. Only keys whose best shard is a
    new one move when it is added, and only those of a removed one when it goes. Ties go to
    the smaller shard; a null key is treated as a key of its own."""
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("weights have to be positive")
    text = F.coalesce(key.cast("string"), F.lit("null"))
    scored = []
    for shard, weight in sorted(weights.items()):
        u = (hash52(F.concat(text, F.lit(f"#{shard}"))) + F.lit(0.5)) / F.lit(float(HASH_SPACE))
        scored.append(F.struct((-F.lit(float(weight)) / F.log(u)).alias("s"), F.lit(-shard).alias("k")))
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return (-best["k"]).cast("int")


def shard(
    df: DataFrame, weights: dict[int, float], key: str = "doc_id", text: str = "text", grown: float | None = None
) -> DataFrame:
    """One narrow row per record: its shard and its gapless place in it.

    Columns: ``key``, ``size`` (UTF-8 bytes of the text, 0 for null, plus 1), ``text_crc32``
    (0 for null), ``law``, ``shard``, ``slot`` (from 0, in the order of a hash of key and
    text), ``grown_shard`` (the shard if one more of weight ``grown`` were added, numbered
    after the largest; null without ``grown``). Other columns, also of these names, are left
    aside. A null key is sharded like any other key, repeated rows get slots of their own, an
    empty table gives no rows.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    name = F.col(key)
    more = F.lit(None).cast("int")
    if grown is not None:
        more = rendezvous(name, {**weights, max(weights) + 1: grown})
    rows = df.select(
        name.alias("_key"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        rendezvous(name, weights).alias("shard"),
        more.alias("grown_shard"),
    )
    mark = F.concat_ws("|", F.coalesce(F.col("_key").cast("string"), F.lit("null")), "text_crc32", "size")
    rows = rows.withColumn("_spread", hash52(mark))
    placed = number(rows, "shard", "_spread", ["_key", "text_crc32", "size"], "slot", df.count())
    return placed.select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
