"""The driver's tables seen as trades, book, signals, fills and strategy updates."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.expr import book_features, snapshot_features


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def _events(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("double")
        return self.table("events").withColumn("k", k)

    @property
    def trades(self) -> DataFrame:
        return self._events.select(
            F.col("event_type").alias("symbol"),
            "ts",
            F.col("event_id").alias("trade_id"),
            F.col("value").alias("price"),
            F.col("k").alias("qty"),
            (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        )

    @property
    def book(self) -> DataFrame:
        return self._events.select(
            F.col("event_type").alias("symbol"),
            "ts",
            F.col("event_id").alias("seq"),
            F.col("value").alias("bid_px"),
            (F.col("value") + 0.01 * (1 + F.col("user_id") % 5)).alias("ask_px"),
            F.col("k").alias("bid_qty"),
            (1 + F.col("user_id")).cast("double").alias("ask_qty"),
            F.col("k").alias("vol_base"),
        )

    @property
    def snapshots(self) -> DataFrame:
        renamed = self.book.withColumnsRenamed(
            {"ts": "timestamp", "bid_px": "bid_price", "ask_px": "ask_price", "vol_base": "volume"}
        )
        return renamed.withColumns(snapshot_features())

    @property
    def book_features(self) -> DataFrame:
        return self.book.withColumns(book_features())

    def _logs(self, *kinds: str) -> DataFrame:
        user = (F.col("user_id") % 10).cast("string")
        return self._events.where(F.col("event_type").isin(*kinds)).withColumn("symbol", F.concat(F.lit("U"), user))

    @property
    def signals(self) -> DataFrame:
        return self._logs("click", "view").select(
            "symbol",
            "ts",
            F.col("event_id").alias("signal_id"),
            (F.col("user_id") % 7).alias("strategy_id"),
            (F.col("k").cast("bigint") % 3 - 1).alias("signal_value"),
            (F.col("user_id") % 3 == 0).alias("entry_allowed"),
            F.col("value").alias("mid_price"),
        )

    @property
    def fills(self) -> DataFrame:
        return self._logs("purchase").select(
            "symbol",
            "ts",
            F.col("event_id").alias("fill_id"),
            F.col("user_id").alias("order_id"),
            F.when(F.col("event_id") % 2 == 0, "BUY").otherwise("SELL").alias("side"),
            F.col("k").alias("qty"),
            F.col("value").alias("price"),
        )

    @property
    def log_fills(self) -> DataFrame:
        return self.fills.withColumnsRenamed({"qty": "fill_qty", "price": "fill_price"})

    @property
    def updates(self) -> DataFrame:
        return self._logs("signup", "error").select(
            "symbol",
            "ts",
            F.col("event_id").alias("update_id"),
            (F.col("user_id") % 7).alias("strategy_id"),
            F.col("k").alias("filled_qty"),
            (100 - F.col("k")).alias("remaining_qty"),
            F.col("value").alias("open_qty"),
            (F.col("value") + F.col("k")).alias("new_open_qty"),
        )

    @property
    def lines(self) -> DataFrame:
        return self.table("lineitem").select(
            F.concat("l_returnflag", "l_linestatus").alias("symbol"),
            F.col("l_shipdate").alias("ts"),
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.try_divide("l_extendedprice", "l_quantity").alias("price"),
            F.col("l_quantity").alias("qty"),
            (F.col("l_linestatus") == "F").alias("is_buyer_maker"),
        )


LINE_ORDER = ("ts", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

# The same views for the SQL side.
_K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
_U = "concat('U', CAST(user_id % 10 AS VARCHAR))"
SQL = {
    "trades": f"SELECT event_type AS symbol, ts, event_id AS trade_id, value AS price, {_K} AS qty, "
    "(user_id % 2 = 0) AS is_buyer_maker FROM events",
    "book": "SELECT event_type AS symbol, ts, event_id AS seq, value AS bid_px, "
    f"value + CAST(0.01 AS DOUBLE) * (1 + user_id % 5) AS ask_px, {_K} AS bid_qty, "
    f"CAST(1 + user_id AS DOUBLE) AS ask_qty, {_K} AS vol_base FROM events",
    "signals": f"SELECT {_U} AS symbol, ts, event_id AS signal_id, user_id % 7 AS strategy_id, "
    f"CAST({_K} AS BIGINT) % 3 - 1 AS signal_value, (user_id % 3 = 0) AS entry_allowed, value AS mid_price "
    "FROM events WHERE event_type IN ('click', 'view')",
    "fills": f"SELECT {_U} AS symbol, ts, event_id AS fill_id, user_id AS order_id, "
    f"CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side, {_K} AS qty, value AS price "
    "FROM events WHERE event_type = 'purchase'",
    "updates": f"SELECT {_U} AS symbol, ts, event_id AS update_id, user_id % 7 AS strategy_id, {_K} AS filled_qty, "
    f"100 - {_K} AS remaining_qty, value AS open_qty, value + {_K} AS new_open_qty "
    "FROM events WHERE event_type IN ('signup', 'error')",
    "lines": "SELECT concat(l_returnflag, l_linestatus) AS symbol, l_shipdate AS ts, l_orderkey, l_linenumber, "
    "l_partkey, l_suppkey, l_extendedprice / l_quantity AS price, l_quantity AS qty, "
    "(l_linestatus = 'F') AS is_buyer_maker FROM lineitem",
}


# Many values of the tables end in 5 at the seventh place. The shift moves the
# rounding edge away from them, since a last-bit difference of two sums would
# otherwise decide how they round.
SHIFT = "0.1234"


def rounded(x: Column) -> Column:
    return F.rint(x * F.lit(1e6) + F.lit(float(SHIFT))) / F.lit(1e6) + F.lit(0.0)


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: whole numbers as bigint, doubles to 6 places."""
    picks = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = rounded(c.cast("double"))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        picks.append(c.alias(f.name))
    return df.select(*picks)
