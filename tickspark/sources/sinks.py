"""Sinks: split datasets with their metadata, per-symbol tables, CSV and the
partitioned layouts of live data. Paths may be on any Hadoop file system."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_json(spark: SparkSession, path: str, value: dict | list) -> None:
    """One small document."""
    line = spark.createDataFrame([(json.dumps(value, default=str),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict | list:
    return json.loads(spark.read.text(path).first()["value"])


def feature_names(df: DataFrame) -> list[str]:
    """Columns that are neither keys, labels nor split marks."""
    return [c for c in df.columns if not c.startswith("y_") and c not in ("ts", "symbol", "split", "label")]


def label_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("y_") or c == "label"]


def write_splits(df: DataFrame, path: str, *, extra: dict | None = None, by: Sequence[str] = ()) -> dict:
    """A frame with a ``split`` column as ``path/data/split=...`` and its metadata
    (row counts, feature and label names) as ``path/metadata``."""
    spark = df.sparkSession
    df.write.mode("overwrite").partitionBy("split", *by).parquet(f"{path}/data")
    sizes = spark.read.parquet(f"{path}/data").groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["split"]: r["n"] for r in sizes.collect()}
    meta = {
        **{f"n_{s}": counts.get(s, 0) for s in ("train", "val", "test")},
        "feature_columns": feature_names(df),
        "label_columns": label_names(df),
        **(extra or {}),
    }
    write_json(spark, f"{path}/metadata", meta)
    return meta


def write_by_symbol(df: DataFrame, path: str) -> None:
    """``path/symbol=...``. Each task writes the symbols it holds, so a large symbol is
    written by many tasks and nothing is shuffled."""
    df.write.mode("overwrite").partitionBy("symbol").parquet(path)


def to_csv(df: DataFrame, path: str, preview: int = 0) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
    if preview:
        df.show(preview, truncate=False)


def dated(df: DataFrame, ts: str) -> DataFrame:
    """Add the ``date`` and ``hour`` partition columns of the live layouts."""
    return df.withColumns(
        {"date": F.to_date(ts), "hour": F.date_format(F.col(ts).cast("timestamp"), "HH")}
    )


def write_features(df: DataFrame, path: str, ts: str = "timestamp_dt", mode: str = "append") -> None:
    """Features as ``symbol=/date=/hour=`` parquet."""
    dated(df, ts).write.mode(mode).partitionBy("symbol", "date", "hour").parquet(path)


def stream_messages(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "timestamp_dt",
    *,
    every: str | None = "5 seconds",
) -> StreamingQuery:
    """Messages to gzipped JSON below ``symbol=/date=/hour=``, flushed at the given
    pace, or once for everything available when ``every`` is None."""
    writer = (
        dated(messages, ts)
        .writeStream.format("json")
        .option("path", path)
        .option("compression", "gzip")
        .option("checkpointLocation", checkpoint)
        .partitionBy("symbol", "date", "hour")
        .outputMode("append")
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def feature_key(key: str) -> str:
    """Output key of a raw key: the features folder, as parquet."""
    out = key.replace("trades/", "features/")
    for ending in (".json.gz", ".json", ".store"):
        if out.endswith(ending):
            return out.removesuffix(ending) + ".parquet"
    return out


def feature_key_column(key: Column | str) -> Column:
    """``feature_key`` of a column of raw keys."""
    out = F.replace(F.col(key) if isinstance(key, str) else key, F.lit("trades/"), F.lit("features/"))
    return F.regexp_replace(out, r"\.(json\.gz|json|store)$", ".parquet")
