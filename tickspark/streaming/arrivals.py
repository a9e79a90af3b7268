"""Features of files as they arrive, with a quarantine for what cannot be used."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickspark import schemas
from tickspark.functions.expr import normalise_ticks
from tickspark.operators.windows import tick_features
from tickspark.sources.readers import streamer_cells
from tickspark.sources.sinks import dated, feature_key_column

# Why a row is put aside, in the order the rules are asked.
MALFORMED_FILE = "malformed file"
MALFORMED_ROW = "malformed row"
NO_TIME = "no time"
NO_PRICE = "no price"
NO_QUANTITY = "no quantity"

TICK_COLUMNS = ["source", "position", "symbol", "timestamp", "price", "qty", "trade_direction", "timestamp_dt"]


class Arrivals(NamedTuple):
    """``ticks`` carry their ``source`` and their ``position`` in it, which puts ticks of equal
    time in order. ``rejected`` rows have source, position (null for a whole file), the ``rule``
    they broke and the ``raw`` text. ``results`` say per file ``success`` (some rows are good),
    ``skipped`` (nothing in it) or ``error``, with the counts of good and rejected rows, a
    ``reason`` (the rule broken most, or "no data") and the ``output_key`` of its features."""

    ticks: DataFrame
    rejected: DataFrame
    results: DataFrame


def arrival_stream(spark: SparkSession, path: str, *, max_files: int = 1000) -> DataFrame:
    """(source, content): whole small files, as flushed by an ingest job."""
    return (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
        .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("content"))
    )


def _messages(files: DataFrame) -> DataFrame:
    """Rows of JSON files, an array of messages or one message, each with the rule it breaks."""
    body = F.trim("content")
    listed = F.when(body.startswith("["), body).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    # Elements stay text at first, so that a bad one can be kept as it came.
    texts = files.select("source", "content", F.from_json(listed, "array<string>").alias("texts"))
    broken = texts.where(F.col("texts").isNull() & (body != ""))
    rows = texts.select("source", F.posexplode("texts").alias("position", "raw"))
    message = F.from_json("raw", f"{_fields()}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    rows = rows.select("source", "position", "raw", message.alias("m")).select("source", "position", "raw", "m.*")
    rows = normalise_ticks(rows.withColumnRenamed("s", "symbol"))
    is_object = F.coalesce(F.ltrim("raw").startswith("{"), F.lit(False))
    rows = rows.withColumn("malformed", ~is_object).select(*TICK_COLUMNS, "raw", "malformed")
    whole = broken.select("source", F.col("content").alias("raw"), F.lit(True).alias("malformed"))
    return rows.unionByName(whole, allowMissingColumns=True)


def _fields() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.MESSAGES)


def _lines(files: DataFrame) -> DataFrame:
    """Rows of ``.store`` files, one a line; blank lines are none."""
    lines = files.select("source", F.posexplode(F.split("content", "\\r?\\n")).alias("position", "raw"))
    lines = lines.where(F.trim("raw") != "")
    rows = normalise_ticks(streamer_cells(lines, "raw", keep=["source", "position", "raw", "fields"]))
    return rows.withColumn("malformed", F.col("fields") < 6).select(*TICK_COLUMNS, "raw", "malformed")


def _rule() -> Column:
    return (
        F.when(F.col("malformed") & F.col("position").isNull(), MALFORMED_FILE)
        .when(F.col("malformed"), MALFORMED_ROW)
        .when(F.col("timestamp").isNull(), NO_TIME)
        .when(F.col("price").isNull(), NO_PRICE)
        .when(F.col("qty").isNull(), NO_QUANTITY)
    )


def parse_arrivals(files: DataFrame) -> Arrivals:
    """Split (source, content) into ticks, rejected rows and a result per file."""
    is_store = F.col("source").endswith(".store")
    rows = _messages(files.where(~is_store)).unionByName(_lines(files.where(is_store))).withColumn("rule", _rule())
    ticks = rows.where(F.col("rule").isNull()).select(*TICK_COLUMNS)
    rejected = rows.where(F.col("rule").isNotNull()).select("source", "position", "rule", "raw")

    # Counted by rule first, so that a large file is added up by many tasks.
    counts = rows.groupBy("source", "rule").agg(F.count(F.lit(1)).alias("n"))
    is_good = F.col("rule").isNull()
    totals = counts.groupBy("source").agg(
        F.sum(F.when(is_good, F.col("n")).otherwise(0)).alias("record_count"),
        F.sum(F.when(is_good, 0).otherwise(F.col("n"))).alias("rejected_count"),
        F.max(F.when(~is_good, F.struct("n", "rule"))).alias("worst"),
    )
    known = files.select("source").distinct().join(totals, "source", "left")
    good, bad = (F.coalesce(c, F.lit(0).cast("bigint")) for c in ("record_count", "rejected_count"))
    status = F.when(good > 0, "success").when(bad > 0, "error").otherwise("skipped")
    results = known.select(
        "source",
        good.alias("record_count"),
        bad.alias("rejected_count"),
        status.alias("status"),
        F.when(good + bad == 0, "no data").otherwise(F.col("worst.rule")).alias("reason"),
        F.when(good > 0, feature_key_column("source")).alias("output_key"),
    )
    return Arrivals(ticks, rejected, results)


def process_arrivals(
    spark: SparkSession,
    source: str,
    features: str,
    results: str,
    checkpoint: str,
    *,
    quarantine: str | None = None,
    every: str | None = None,
    per_file: bool = True,
) -> StreamingQuery:
    """Compute tick features of each arriving file and append them to the feature table, with
    one result row per file and the rejected rows in ``quarantine`` (by default the results'
    path with ``-rejected``). ``per_file`` restarts the rolling state at every file; without it
    state runs over the files of one batch. Features carry the ``output_key`` of their file."""
    rejects = quarantine or f"{results.rstrip('/')}-rejected"

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Read the files once for the features, the quarantine and the results.
        batch.persist()
        try:
            found = parse_arrivals(batch)
            by = ["source", "symbol"] if per_file else ["symbol"]
            order = ["timestamp", "position"] if per_file else ["timestamp", "source", "position"]
            made = tick_features(found.ticks, by=by, order=order, plain=True).drop("position")
            made = made.withColumn("output_key", feature_key_column("source"))
            # Overwriting the batch's own folders makes a repeated batch harmless.
            dated(made, "timestamp_dt").write.mode("overwrite").partitionBy("symbol", "date", "hour").parquet(
                f"{features}/batch={batch_id}"
            )
            found.rejected.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
            found.results.write.mode("overwrite").parquet(f"{results}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = arrival_stream(spark, source).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
