"""Structured Streaming forms of ingest, bars, deduplication and segments; features on arrival
are in ``arrivals``, stateful steps in ``state``. Rows later than the watermark are dropped;
``LateRows`` counts them."""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickspark import schemas
from tickspark.functions.expr import interval_literal, normalise_ticks
from tickspark.operators.bars import flow_aggregates, flow_derived
from tickspark.sources.sinks import stream_messages
from tickspark.streaming.arrivals import arrival_stream, parse_arrivals, process_arrivals
from tickspark.streaming.state import FLUSH_ROWS, FLUSH_SECONDS, batched, require_state_store, stream_tick_features

__all__ = [
    "LateRows",
    "arrival_stream",
    "ingest",
    "message_stream",
    "parse_arrivals",
    "process_arrivals",
    "run_available",
    "stream_dedup",
    "stream_flow_bars",
    "stream_segments",
    "stream_tick_features",
]


# -- ingest ---------------------------------------------------------------------------


def message_stream(spark: SparkSession, path: str, *, max_files: int = 1000) -> DataFrame:
    """Live trade messages arriving as JSON files: symbol and normalised tick columns."""
    raw = (
        spark.readStream.schema(schemas.MESSAGES)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", True)
        .json(path)
    )
    return normalise_ticks(raw.withColumnRenamed("s", "symbol"))


def ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    *,
    rows: int = FLUSH_ROWS,
    seconds: float | None = FLUSH_SECONDS,
    every: str | None = "1 second",
    lanes: int = 1,
) -> StreamingQuery:
    """Write arriving messages to ``symbol=/date=/hour=`` JSON, with their ``batch`` and their
    ``place`` in it. Each symbol has a buffer that is flushed at ``rows`` messages or
    ``seconds`` after its first one; ``lanes`` gives a busy symbol several. With ``every`` None
    the stream drains what has arrived and stops, so nothing waits. The file sink commits each
    micro-batch once, so a failed flush is repeated and never doubled."""
    require_state_store(spark)
    messages = message_stream(spark, source)
    lane = F.pmod(F.xxhash64(*messages.columns), F.lit(lanes)) if lanes > 1 else F.lit(0)
    key = F.concat_ws("#", "symbol", lane.cast("string"))
    flushed = batched(messages.withColumn("lane", lane.cast("int")), key, size=rows, seconds=seconds if every else None)
    return stream_messages(flushed, target, checkpoint, every=every)


# -- bars -----------------------------------------------------------------------------------


def stream_flow_bars(
    trades: DataFrame,
    every: str = "1s",
    *,
    delay: str = "10 seconds",
    by: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("ts", "trade_id"),
    ts: str = "ts",
) -> DataFrame:
    """Flow bars of a stream, each emitted once when the watermark passes its end."""
    bars = (
        trades.withWatermark(ts, delay)
        .groupBy(*by, F.window(ts, interval_literal(every)).alias("__w"))
        .agg(*[c.alias(n) for n, c in flow_aggregates(order).items()])
    )
    bars = flow_derived(bars)
    return bars.select(*by, F.col("__w.start").alias(ts), *[c for c in bars.columns if c not in {*by, "__w"}])


# -- dedup and segments ---------------------------------------------------------------------------


def stream_dedup(df: DataFrame, keys: Sequence[str] = ("symbol", "ts"), *, delay: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """First row of each key; a copy within the delay is dropped."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_segments(
    df: DataFrame, gap: str = "1s", *, delay: str = "10 seconds", by: Sequence[str] = ("symbol",), ts: str = "ts"
) -> DataFrame:
    """(by.., start, end, n): runs of rows no farther apart than ``gap``."""
    return (
        df.withWatermark(ts, delay)
        .groupBy(*by, F.session_window(ts, interval_literal(gap)).alias("__w"))
        .agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("n"))
        .drop("__w")
    )


# -- late rows ------------------------------------------------------------------------------


class LateRows(StreamingQueryListener):
    """Rows each query has dropped so far for being later than the watermark, from every
    progress report and not only from the last hundred that a query remembers.

    late = LateRows.watch(spark)   # before the query starts
    late.total(query)
    """

    def __init__(self) -> None:
        self._totals: dict[str, int] = defaultdict(int)
        self._seen: dict[str, int] = defaultdict(lambda: -1)
        self._lock = threading.Lock()

    @classmethod
    def watch(cls, spark: SparkSession) -> LateRows:
        made = cls()
        spark.streams.addListener(made)
        return made

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            run = str(progress.runId)
            self._totals[run] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
            self._seen[run] = max(self._seen[run], progress.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, query: StreamingQuery, timeout: float = 30.0) -> int:
        """Waits until the last report of the query has come in, which it does a little later."""
        run, last = str(query.runId), query.lastProgress
        until = time.monotonic() + timeout
        while last is not None and self._seen[run] < last["batchId"]:
            if time.monotonic() > until:
                raise TimeoutError("no progress report")
            time.sleep(0.05)
        with self._lock:
            return self._totals[run]


def run_available(
    df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Run a stream over everything available now, handing each batch to ``sink``."""
    query = (
        df.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
