"""Removal of lines that are spread over many sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.session import stage

# A line on at least this many sites is boilerplate.
SITES = 10
# log2 of the sketch's registers; its relative error has a deviation of 1.04 / sqrt(2 ** 12).
REGISTERS = 12
# Estimates within this many deviations of the threshold are counted exactly.
DEVIATIONS = 4
# A common line's rows are dealt over this many keys when they meet the verdict on it.
SALTS = 32


def line_key(line: Column) -> Column:
    """128 bits of a line with the white space at its ends removed and A-Z lower-cased; null
    for a blank line."""
    body = F.lower(F.regexp_replace(line, r"^\s+|\s+$", ""))
    return F.when(body != "", F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit("line"), body).alias("b")))


def widespread(lines: DataFrame, sites: int, registers: int = REGISTERS) -> DataFrame:
    """Keys of the lines (key, site) that occur on at least ``sites`` distinct sites.

    Each line's HyperLogLog sketch of its sites is built where the rows are and merged by the
    shuffle, so a common line is one row per task. An estimate clearly off the threshold
    decides; lines near it are counted exactly, again combined before the shuffle.
    """
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(registers)))
    spread = lines.groupBy("key").agg(sketch.alias("about"))
    margin = DEVIATIONS * 1.04 / 2 ** (registers / 2)
    spread = stage(spread.filter(F.col("about") >= sites * (1 - margin) - 0.5))
    sure = spread.filter(F.col("about") > sites * (1 + margin) + 0.5).select("key")
    near = spread.filter(F.col("about") <= sites * (1 + margin) + 0.5).select("key")
    pairs = lines.join(near, "key", "left_semi").distinct()
    exact = pairs.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= sites).select("key")
    return sure.unionByName(exact)


def drop_lines(
    df: DataFrame, sites: int = SITES, text: str = "text", site: str = "source", key: str = "doc_id"
) -> DataFrame:
    """One row per row: ``key``, ``site``, ``text`` without its widespread lines, ``n_lines``,
    ``removed`` (positions of the lines taken out, from 0) and ``n_removed``.

    Lines end at a line feed. They are compared without white space at their ends and with
    letters lower-cased; blank lines are never removed. A null site is one site of its own. A
    null text stays null and has no lines. Repeated rows are treated alike. Other columns are
    left aside; an empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("id"), F.col(site).cast("string").alias("site"), F.col(text).cast("string").alias("body"))
    named = rows.select(F.coalesce("site", F.lit("\x00none")).alias("site"), "id", "body")
    mark = F.struct("id", F.xxhash64("body").alias("h"))
    lines = named.select(mark.alias("doc"), "site", F.posexplode(F.split("body", "\n")).alias("pos", "line"))
    # Split and hashed once; what follows reads these narrow rows instead of the texts.
    lines = stage(lines.select("doc", "site", "pos", line_key(F.col("line")).alias("key")).filter("key IS NOT NULL"))
    common = stage(widespread(lines.select("key", "site"), sites))
    salt = F.pmod(F.xxhash64("doc", "pos"), F.lit(SALTS)).cast("int")
    salted = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hit = lines.withColumn("salt", salt).join(salted, ["key", "salt"], "left_semi").select("doc", "pos").distinct()
    hit = hit.groupBy("doc").agg(F.sort_array(F.collect_list("pos")).alias("removed"))
    joined = rows.withColumn("doc", mark).join(hit.withColumnRenamed("doc", "hit"), F.col("doc").eqNullSafe(F.col("hit")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    parts = F.split("body", "\n")
    left = F.filter(parts, lambda line, i: ~F.array_contains(removed, i))
    clean = F.when(F.col("removed").isNull(), F.col("body")).otherwise(F.array_join(left, "\n"))
    return joined.select(
        F.col("id").alias(key),
        F.col("site").alias(site),
        clean.alias(text),
        F.when(F.col("body").isNull(), 0).otherwise(F.size(parts)).cast("int").alias("n_lines"),
        removed.alias("removed"),
        F.size(removed).alias("n_removed"),
    )
