"""Stateful steps of streams. They hold rows back and let them go, in bounded runs; everything
that is computed from the rows is left to the batch operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickspark.functions.expr import interval_micros
from tickspark.operators.windows import FLOW_WINDOWS, TICK_LAGS, TICK_WINDOWS, tick_features

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# One batch is flushed at 1000 messages or after 5 seconds.
FLUSH_ROWS = 1000
FLUSH_SECONDS = 5

# Rows handed on at a time.
RUN = 10_000


def require_state_store(spark: SparkSession) -> None:
    """List state and timers need this state store; it has to be set before a stream starts."""
    if spark.conf.get(PROVIDER, "") != ROCKSDB:
        raise ValueError(f"set {PROVIDER} to {ROCKSDB}")


# -- message batches --------------------------------------------------------------------


class Buffer(StatefulProcessor):
    """Messages of one key, let go in batches of ``size``, or after ``seconds`` what there is.
    Without ``seconds`` nothing is held beyond the micro-batch."""

    def __init__(self, size: int, seconds: float | None) -> None:
        self.size, self.seconds = size, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "message string")
        self.counts = handle.getValueState("counts", "waiting long, batches long")

    def _load(self) -> tuple[int, int]:
        return tuple(self.counts.get()) if self.counts.exists() else (0, 0)

    def _frame(self, key: tuple, rows: list, batch: int):
        import pandas as pd

        return pd.DataFrame({"key": str(key[0]), "batch": batch, "place": range(len(rows)), "message": rows})

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        waiting, batches = self._load()
        fresh: list = []
        for frame in rows:
            fresh += frame["message"].tolist()
        if waiting + len(fresh) >= self.size or self.seconds is None:
            fresh = [m[0] for m in self.held.get()] + fresh if waiting else fresh
            self.held.clear()
            if self.seconds is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
            whole = len(fresh) if self.seconds is None else len(fresh) // self.size * self.size
            for at in range(0, whole, self.size):
                yield self._frame(key, fresh[at : min(whole, at + self.size)], batches)
                batches += 1
            fresh, waiting = fresh[whole:], 0
        if fresh:
            if not waiting:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.seconds * 1000))
            self.held.appendList([(m,) for m in fresh])
        self.counts.update((waiting + len(fresh), batches))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        waiting, batches = self._load()
        if waiting:
            yield self._frame(key, [m[0] for m in self.held.get()], batches)
            self.held.clear()
            self.counts.update((0, batches + 1))

    def close(self) -> None:
        pass


def batched(messages: DataFrame, key: Column, *, size: int = FLUSH_ROWS, seconds: float | None = FLUSH_SECONDS) -> DataFrame:
    """The rows of a stream with their ``batch`` within the key and ``place`` in it: a batch is
    let go at ``size`` rows or ``seconds`` after its first row. With ``seconds`` None, what has
    arrived is let go at once, for streams that run until nothing is left."""
    names = messages.columns
    packed = messages.select(
        F.coalesce(key.cast("string"), F.lit("")).alias("key"),
        F.to_json(F.struct(*names)).alias("message"),
    )
    mode = "none" if seconds is None else "processingTime"
    out = packed.groupBy("key").transformWithStateInPandas(
        Buffer(size, seconds), "key string, batch long, place long, message string", "append", mode
    )
    row = F.from_json("message", messages.schema)
    return out.select("batch", "place", row.alias("row")).select("row.*", "batch", "place")


# -- ticks in order ---------------------------------------------------------------------

_TICK = "at long, tie long, price double, qty double, side double"
_NAMES = [part.split()[0] for part in _TICK.split(", ")]


class Release(StatefulProcessor):
    """Ticks of one symbol and time slice, let go once the watermark has passed the slice."""

    def __init__(self, slice_us: int) -> None:
        self.slice_us = slice_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _TICK)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        for frame in rows:
            self.held.appendList(list(frame[_NAMES].itertuples(index=False, name=None)))
        end = -(-(int(key[1]) + 1) * self.slice_us // 1000)
        self.handle.registerTimer(end)  # the same timer for all rows of the slice
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        def frame(rows: list):
            out = pd.DataFrame(rows, columns=_NAMES)
            out.insert(0, "symbol", key[0])
            return out

        rows: list = []
        for row in self.held.get():
            rows.append(row)
            if len(rows) == RUN:
                yield frame(rows)
                rows = []
        if rows:
            yield frame(rows)
        self.held.clear()

    def close(self) -> None:
        pass


def in_time(ticks: DataFrame, *, delay: str, ts: str, tie: str | None, slice_: str) -> DataFrame:
    """(symbol, at, tie, price, qty, side) of a stream, let go in time slices: every row of a
    slice comes in one micro-batch, after all rows of earlier slices. State is kept per symbol
    and slice, so the ticks of a symbol with a third of all rows are held by many tasks."""
    slice_us = interval_micros(slice_)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = ticks.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    rows = rows.select(
        F.coalesce("symbol", F.lit("")).alias("symbol"),
        ts,
        F.floor(at / slice_us).alias("slice"),
        at.alias("at"),
        F.coalesce(F.col(tie or ts).cast("bigint"), F.lit(0)).alias("tie"),
        F.col("price").cast("double").alias("price"),
        F.col("qty").cast("double").alias("qty"),
        F.col("trade_direction").cast("double").alias("side"),
    )
    out = rows.groupBy("symbol", "slice").transformWithStateInPandas(
        Release(slice_us), f"symbol string, {_TICK}", "append", "eventTime"
    )
    # pandas has NaN in place of a missing number.
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("price", "qty", "side")})


_HISTORY = max(*TICK_WINDOWS, *TICK_LAGS, *FLOW_WINDOWS) + 1
_ORDER = ("at", "tie", "price", "qty")


def tick_feature_schema() -> T.StructType:
    names = ["price", "qty", "side", "return_1"]
    for w in TICK_WINDOWS:
        names += [f"price_ma_{w}", f"price_std_{w}", f"volume_sum_{w}", f"return_ma_{w}"]
    for k in TICK_LAGS:
        names += [f"price_lag_{k}", f"return_lag_{k}"]
    names += [f"order_flow_{w}" for w in FLOW_WINDOWS]
    head = [T.StructField("symbol", T.StringType()), T.StructField("at", T.LongType())]
    return T.StructType(head + [T.StructField(n, T.DoubleType()) for n in names])


def stream_tick_features(
    ticks: DataFrame,
    target: str,
    state: str,
    checkpoint: str,
    *,
    delay: str = "10 seconds",
    ts: str = "ts",
    tie: str | None = None,
    slice_: str = "10s",
    every: str | None = None,
) -> StreamingQuery:
    """Rolling and lag tick features of a stream, written below ``target`` as
    ``batch=``/parquet, running on across files and batches.

    Ticks wait in state until the watermark has passed their time slice, so their order is
    final. Each micro-batch computes the features of the ticks let go by the batch operator,
    with the last few ticks of every symbol before them; those are kept below ``state``, which
    has to be on storage all executors share. Only two versions of them are kept, the one read
    and the one written, so a repeated batch finds what it found before.

    ``tie`` names the whole-number column that orders ticks of equal time, such as a trade id.
    Without it they are taken by price and quantity, so that a repeated batch agrees. A null
    symbol is the empty one; ticks without a time have no place in a series and are left out;
    a price or quantity that is not a number counts as missing."""
    spark = ticks.sparkSession
    require_state_store(spark)
    released = in_time(ticks, delay=delay, ts=ts, tie=tie, slice_=slice_)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh_path, tail_path = f"{state}/fresh", f"{state}/tail-{batch_id % 2}"
        batch.write.mode("overwrite").parquet(fresh_path)
        rows = session.read.schema(batch.schema).parquet(fresh_path).withColumn("fresh", F.lit(True))
        if batch_id:
            before = session.read.schema(batch.schema).parquet(f"{state}/tail-{(batch_id + 1) % 2}")
            rows = rows.unionByName(before.withColumn("fresh", F.lit(False)))
        named = rows.withColumn("trade_direction", F.col("side"))
        made = tick_features(named, order=_ORDER, plain=True).where("fresh")
        made = made.select(*tick_feature_schema().fieldNames())
        made.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        latest = Window.partitionBy("symbol").orderBy(*[F.col(c).desc() for c in _ORDER])
        tail = rows.withColumn("n", F.row_number().over(latest)).where(F.col("n") <= _HISTORY)
        tail.select(*batch.columns).write.mode("overwrite").parquet(tail_path)

    writer = released.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()

