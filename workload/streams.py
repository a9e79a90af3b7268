"""Streams over the driver's events, run until nothing is left, and arrivals made of them."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.session import staging_dir
from tickspark.streaming import arrivals, state, streams
from workload.bars_windows import EVENT
from workload.registry import ORACLE, SHARED, query
from workload.views import Views

# A stream ends with its last bars, slices and segments open: rows up to the watermark count.
DELAY = "10 seconds"
PASSED = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 SECOND FROM events)"


@contextmanager
def _run(spark: SparkSession):
    """A folder of one run, on the shared storage, with the state store that streams need."""
    before = spark.conf.get(state.PROVIDER, None)
    spark.conf.set(state.PROVIDER, state.ROCKSDB)
    try:
        yield f"{staging_dir(spark).rstrip('/')}/tickspark-stream-{uuid.uuid4().hex}"
    finally:
        if before is None:
            spark.conf.unset(state.PROVIDER)
        else:
            spark.conf.set(state.PROVIDER, before)


def _feed(df: DataFrame, folder: str) -> DataFrame:
    """A stream of the rows of a frame, from files in the folder."""
    df.write.parquet(f"{folder}/in")
    return df.sparkSession.readStream.schema(df.schema).parquet(f"{folder}/in")


def _collected(stream: DataFrame, folder: str) -> DataFrame:
    """What a stream emits until nothing is left."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    streams.run_available(stream, sink, f"{folder}/checkpoint")
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out").select(*stream.columns)


def _timed(v: Views) -> DataFrame:
    """Trades with an instant, which a watermark needs."""
    return v.trades.withColumn("ts", F.col("ts").cast("timestamp"))


@query(f"SELECT * FROM ({ORACLE['bars_flow']}) b WHERE ts + INTERVAL 1 HOUR <= {PASSED}")
def stream_bars(v: Views):
    with _run(v.spark) as folder:
        out = _collected(streams.stream_flow_bars(_feed(_timed(v), folder), "1h", delay=DELAY, order=EVENT), folder)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _tick_stream_sql() -> str:
    sql = ORACLE["tick_features"]
    sql = sql.replace("SELECT symbol, timestamp, trade_id,", 'SELECT symbol, epoch_us(timestamp) AS "at", R(price) AS price, R(qty) AS qty,', 1)
    return f'SELECT * EXCLUDE (log_price, dollar_volume) FROM ({sql}) t WHERE "at" // 3600000000 < epoch_us({PASSED}) // 3600000000'



@query(_tick_stream_sql())
def stream_ticks(v: Views):
    with _run(v.spark) as folder:
        side = F.when(F.col("is_buyer_maker"), -1).otherwise(1)
        ticks = _feed(_timed(v).withColumn("trade_direction", side), folder)
        streams.stream_tick_features(
            ticks, f"{folder}/out", f"{folder}/state", f"{folder}/checkpoint", delay=DELAY, tie="trade_id", slice_="1h"
        ).awaitTermination()
    return v.spark.read.schema(state.tick_feature_schema()).parquet(f"{folder}/out").drop("side", "batch")


@query("SELECT DISTINCT symbol, ts FROM trades")
def stream_dedup(v: Views):
    with _run(v.spark) as folder:
        twice = _timed(v).unionByName(_timed(v))
        out = _collected(streams.stream_dedup(_feed(twice, folder), ["symbol", "ts"], delay=DELAY), folder)
    return out.select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"))


SHARED["runs"] = """SELECT symbol, ts, sum(CASE WHEN gap < 60000000 THEN 0 ELSE 1 END) OVER (PARTITION BY symbol ORDER BY ts, trade_id
 ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS gap FROM trades)"""


@query(f"""SELECT symbol, min(ts) AS start, max(ts) AS "end", count(*) AS n FROM runs GROUP BY symbol, run
 HAVING max(ts) + INTERVAL 1 MINUTE <= {PASSED}""")
def stream_segments(v: Views):
    with _run(v.spark) as folder:
        out = _collected(streams.stream_segments(_feed(_timed(v), folder), "1m", delay=DELAY), folder)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


# -- messages and files ---------------------------------------------------------------------


def _messages(v: Views) -> DataFrame:
    """Trades as live messages; some are broken in each of the ways that arrivals reject."""
    t = v.trades
    time = F.unix_millis(F.col("ts").cast("timestamp"))
    n = F.col("trade_id") % 50
    # A missing or odd cell is written as it would come.
    cells = [
        F.when(n == 1, F.lit('"T":null')).when(n == 2, F.lit('"T":"soon"')).otherwise(F.concat(F.lit('"T":'), time.cast("string"))),
        F.concat(F.lit('"s":"'), "symbol", F.lit('"')),
        F.when(n == 3, F.lit('"p":""')).when(n == 4, F.lit('"x":1')).otherwise(F.concat(F.lit('"p":"'), F.col("price").cast("string"), F.lit('"'))),
        F.when(n == 5, F.lit('"q":"many"')).otherwise(F.concat(F.lit('"q":"'), F.col("qty").cast("string"), F.lit('"'))),
        F.concat(F.lit('"m":'), F.col("is_buyer_maker").cast("string")),
    ]
    message = F.concat(F.lit("{"), F.concat_ws(",", *cells), F.lit("}"))
    message = F.when(n == 6, F.lit("17")).when(n == 7, F.lit('"text"')).otherwise(message)
    line = F.when(n == 1, F.concat_ws(",", "symbol", F.lit("soon"), "price", "qty", "price", "qty"))
    line = line.when(n == 3, F.concat_ws(",", "symbol", time.cast("string"), F.lit(""), "qty", "price", "qty"))
    line = line.when(n == 6, "cut,off").otherwise(
        F.concat_ws(",", "symbol", time.cast("string"), "price", "qty", F.col("price") + 2, "qty")
    )
    return t.select("trade_id", "price", "qty", F.floor(F.col("trade_id") / 100).alias("file"), message.alias("message"), line.alias("line"))


def _files(v: Views) -> DataFrame:
    """(source, content) of files of 100 trades each, by turns messages and lines; every 20th
    file is broken or empty."""
    rows = _messages(v).groupBy("file").agg(F.sort_array(F.collect_list(F.struct("trade_id", "message", "line"))).alias("rows"))
    store = F.col("file") % 3 == 2
    body = F.when(store, F.concat_ws("\n", F.col("rows.line"))).otherwise(
        F.concat(F.lit("["), F.concat_ws(",", F.col("rows.message")), F.lit("]"))
    )
    kind = F.col("file") % 20
    body = F.when(~store & (kind == 7), F.lit("[]")).when(~store & (kind == 13), F.lit("{oops")).otherwise(body)
    name = F.concat(F.lit("trades/"), F.col("file").cast("string"), F.when(store, ".store").otherwise(".json.gz"))
    return rows.select(name.alias("source"), body.alias("content"))


# The same in SQL: which rule each row breaks.
SHARED["arrived"] = """SELECT *, event_id // 100 AS file, (event_id // 100) % 3 = 2 AS store, event_id % 50 AS k, (event_id // 100) % 20 AS kind,
 concat('trades/', event_id // 100, CASE WHEN (event_id // 100) % 3 = 2 THEN '.store' ELSE '.json.gz' END) AS source FROM events"""
SHARED["ruled"] = """SELECT *, CASE WHEN NOT store AND kind IN (7, 13) THEN 'gone'
 WHEN k = 6 OR (k = 7 AND NOT store) THEN 'malformed row'
 WHEN k = 1 OR (k = 2 AND NOT store) THEN 'no time'
 WHEN k = 3 OR (k = 4 AND NOT store) THEN 'no price'
 WHEN k = 5 AND NOT store THEN 'no quantity' END AS rule FROM arrived"""


@query("""SELECT source, rule, count(*) AS n, min(position) AS first, max(position) AS last FROM (
 SELECT source, rule, row_number() OVER (PARTITION BY source ORDER BY event_id) - 1 AS position FROM ruled)
 WHERE rule <> 'gone' GROUP BY source, rule
 UNION ALL SELECT DISTINCT source, 'malformed file', 1, NULL::BIGINT, NULL::BIGINT FROM ruled WHERE NOT store AND kind = 13""")
def arrivals_rejected(v: Views):
    found = arrivals.parse_arrivals(_files(v)).rejected
    return found.groupBy("source", "rule").agg(
        F.count(F.lit(1)).alias("n"), F.min("position").alias("first"), F.max("position").alias("last")
    )


@query("""SELECT source, good AS record_count, bad AS rejected_count,
 CASE WHEN good > 0 THEN 'success' WHEN bad > 0 THEN 'error' ELSE 'skipped' END AS status,
 CASE WHEN good + bad = 0 THEN 'no data' ELSE reason END AS reason,
 CASE WHEN good > 0 THEN concat('features/', file, '.parquet') END AS output_key
FROM (SELECT source, file, count(*) FILTER (WHERE rule IS NULL) AS good,
  CASE WHEN bool_or(NOT store AND kind = 13) THEN 1 ELSE count(*) FILTER (WHERE rule <> 'gone') END AS bad,
  CASE WHEN bool_or(NOT store AND kind = 13) THEN 'malformed file' ELSE (SELECT arg_max(r, (c, r)) FROM (
    SELECT rule AS r, count(*) AS c FROM ruled i WHERE i.source = o.source AND rule <> 'gone' GROUP BY rule)) END AS reason
 FROM ruled o GROUP BY source, file)""")
def arrivals_results(v: Views):
    return arrivals.parse_arrivals(_files(v)).results


@query("""SELECT source, count(*) AS n, R(sum(CASE WHEN store THEN value + 1 ELSE value END)) AS price,
 R(sum(CAST(json_extract_string(props, '$.k') AS DOUBLE))) AS qty,
 CAST(sum(CASE WHEN store OR user_id % 2 <> 0 THEN 1 ELSE -1 END) AS BIGINT) AS side, min(epoch_us(ts) // 1000) AS start FROM ruled WHERE rule IS NULL GROUP BY source""")
def arrivals_ticks(v: Views):
    found = arrivals.parse_arrivals(_files(v)).ticks
    return found.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price").alias("price"),
        F.sum("qty").alias("qty"),
        F.sum("trade_direction").alias("side"),
        F.min("timestamp").alias("start"),
    )


SHARED["flushed"] = """SELECT symbol, (row_number() OVER (PARTITION BY symbol ORDER BY trade_id) - 1) // 1000 AS batch FROM trades"""


@query("SELECT symbol, batch, count(*) AS n FROM flushed GROUP BY symbol, batch")
def stream_ingest(v: Views):
    with _run(v.spark) as folder:
        time = F.unix_millis(F.col("ts").cast("timestamp"))
        message = F.to_json(F.struct(time.alias("T"), F.col("symbol").alias("s"), F.col("price").cast("string").alias("p")))
        many = v.trades.groupBy(F.floor(F.col("trade_id") / 1000).alias("file")).agg(F.collect_list(message).alias("messages"))
        content = F.concat(F.lit("["), F.concat_ws(",", "messages"), F.lit("]"))
        # One array of messages per file, as they arrive.
        many.select(content.alias("value")).write.option("maxRecordsPerFile", 1).text(f"{folder}/in")
        streams.ingest(v.spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", every=None).awaitTermination()
    made = v.spark.read.json(f"{folder}/out")
    return made.groupBy("symbol", "batch").agg(F.count(F.lit(1)).alias("n"))
