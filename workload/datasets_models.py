"""Composed datasets, reports and models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.functions.expr import micros
from tickspark.operators import bars, labels, metrics, models, splits, windows
from tickspark.operators.align import fill_within, union_all
from tickspark.plans import datasets
from tickspark.session import stage
from workload.bars_windows import flow, frame, full, ticks
from workload.joins_labels import three
from workload.quality_splits import hours
from workload.registry import SHARED, query
from workload.views import Views

# -- public trades -------------------------------------------------------------------

SHARED["made"] = f"""SELECT symbol, ts, close, {full('sum', 'volume', 5)} AS vol_sum_5, {full('stddev_samp', 'log_return', 15)} AS ret_std_15,
 y_ret_5, {three('y_ret_5', '5e-4::DOUBLE')} AS y_dir_5, y_ret_30, {three('y_ret_30', '5e-4::DOUBLE')} AS y_dir_30
 FROM rets WINDOW {frame(5, 5)}, {frame(15, 15)}"""


def _made(v: Views) -> DataFrame:
    return datasets.trade_features(v.trades, "1h", (5, 15), (5, 30))


@query("""SELECT symbol, ts, R(close) AS close, R(vol_sum_5) AS vol_sum_5, R(ret_std_15) AS ret_std_15, R(y_ret_5) AS y_ret_5,
 y_dir_5, R(y_ret_30) AS y_ret_30, y_dir_30 FROM made""")
def trade_features(v: Views):
    cols = ["close", "vol_sum_5", "ret_std_15", "y_ret_5", "y_dir_5", "y_ret_30", "y_dir_30"]
    return _made(v).select("symbol", "ts", *cols)


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n
 FROM made WHERE y_ret_5 IS NOT NULL AND y_ret_30 IS NOT NULL), c AS (SELECT *, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS te,
 CAST(floor(n * 0.15::DOUBLE) AS BIGINT) AS w FROM k), p AS (SELECT *, CASE WHEN i < te THEN 'train' WHEN i >= te + 20 AND i < te + 20 + w
 THEN 'val' WHEN i >= te + 40 + w THEN 'test' END AS split FROM c)
 SELECT symbol, ts, split, y_dir_30 FROM p WHERE split IS NOT NULL""")
def trade_split(v: Views):
    known = _made(v).dropna(subset=["y_ret_5", "y_dir_5", "y_ret_30", "y_dir_30"])
    return splits.split_rows(known, embargo=20).select("symbol", "ts", "split", "y_dir_30")


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n
 FROM made WHERE y_dir_30 IS NOT NULL)
 SELECT symbol, ts, CASE WHEN i < n - greatest(1, CAST(floor(n * 0.2::DOUBLE) AS BIGINT)) THEN 'train' ELSE 'val' END AS split, y_dir_30,
 R(coalesce(vol_sum_5, 0)) AS vol_sum_5 FROM k""")
def trade_training(v: Views):
    data = datasets.trade_training_set(v.trades, "1h", 30, 5.0, (5, 15))
    return data.df.select("symbol", "ts", "split", data.label, "vol_sum_5")


# -- order book ------------------------------------------------------------------------

SHARED["hb0"] = """SELECT symbol, timestamp AS ts, bid_price AS bid_px, ask_price AS ask_px, bid_qty, ask_qty, volume AS vol_base,
 epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (PARTITION BY symbol ORDER BY timestamp) AS gap FROM bookbars"""
SHARED["hb1"] = """SELECT *, CAST(sum(CASE WHEN gap = 3600000000 THEN 0 ELSE 1 END) OVER (PARTITION BY symbol ORDER BY ts
 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_id FROM hb0"""
SHARED["hb2"] = """SELECT *, (bid_px + ask_px) / 2 AS mid, CASE WHEN (bid_px + ask_px) / 2 > 0 THEN ln((bid_px + ask_px) / 2) END AS log_mid,
 ask_px - bid_px AS spread, count(*) OVER (PARTITION BY symbol, segment_id) AS len FROM hb1"""
SHARED["hb3"] = """SELECT *, log_mid - lag(log_mid) OVER w AS r1, lead(log_mid) OVER w - log_mid AS y_ret_1,
 lead(log_mid, 2) OVER w - log_mid AS y_ret_2 FROM hb2 WHERE len >= 6 WINDOW w AS (PARTITION BY symbol, segment_id ORDER BY ts)"""
SHARED["hb4"] = """SELECT *, count(r1) OVER (PARTITION BY symbol, segment_id ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n_r1,
 count(r1) OVER (PARTITION BY symbol, segment_id ORDER BY ts ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n2_r1 FROM hb3"""
SHARED["hb5"] = """SELECT *, row_number() OVER (PARTITION BY symbol, segment_id ORDER BY ts) - 1 AS i,
 count(*) OVER (PARTITION BY symbol, segment_id) AS n FROM hb4 WHERE r1 IS NOT NULL AND n2_r1 >= 2 AND y_ret_2 IS NOT NULL"""
SHARED["hb6"] = """SELECT *, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train' WHEN i < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE)
 THEN 'val' ELSE 'test' END AS split FROM hb5"""
SHARED["hb7"] = """SELECT symbol, segment_id, max(epoch_us(ts)) FILTER (split = 'train') AS a, max(epoch_us(ts)) FILTER (split = 'val') AS b
 FROM hb6 GROUP BY ALL"""
SHARED["hb8"] = """SELECT hb6.* FROM hb6 JOIN hb7 USING (symbol, segment_id) WHERE split = 'train'
 OR (split = 'val' AND (a IS NULL OR epoch_us(ts) > a + 3600000000)) OR (split = 'test' AND (coalesce(CASE WHEN a IS NULL OR
 b > a + 3600000000 THEN b END, a) IS NULL OR epoch_us(ts) > coalesce(CASE WHEN a IS NULL OR b > a + 3600000000 THEN b END, a) + 3600000000))"""


def _hourly_book(v: Views) -> DataFrame:
    rows = bars.book_bars(v.snapshots, "1h", order=("timestamp", "seq"))
    names = {"timestamp": "ts", "bid_price": "bid_px", "ask_price": "ask_px", "volume": "vol_base"}
    return rows.withColumnsRenamed(names).select("symbol", "ts", "bid_px", "ask_px", "bid_qty", "ask_qty", "vol_base")


@query(f"""WITH f AS (SELECT avg(mid) AS c, stddev_pop(mid) AS s FROM hb8 WHERE split = 'train')
 SELECT symbol, ts, segment_id, split, R((mid - c) / s) AS mid, R(y_ret_1) AS y_ret_1,
 {three('y_ret_2', 'ln((mid + spread / 2) / mid)')} AS y_dir_2 FROM hb8, f""")
def book_dataset(v: Views):
    data = datasets.book_dataset(
        _hourly_book(v), expected="1h", min_segment=6, windows=(2, 3), horizons=(1, 2), embargo_s=3600
    )
    return data.df.select("symbol", "ts", "segment_id", "split", "mid", "y_ret_1", "y_dir_2")


# -- several sources ----------------------------------------------------------------------

_US = "concat('U', CAST(user_id % 10 AS VARCHAR))"
SHARED["usnap"] = f"""SELECT {_US} AS symbol, ts, event_id AS seq, value + 0.01::DOUBLE * (1 + user_id % 5) / 2 AS mid_price FROM events"""
SHARED["ubars"] = """SELECT symbol, date_trunc('hour', t.ts) AS timestamp, arg_max(mid_price, (t.ts, seq)) AS close, count(*) AS tick_count
 FROM usnap t GROUP BY symbol, date_trunc('hour', t.ts)"""
SHARED["ugrid"] = """SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS timestamp FROM (SELECT symbol, max(lo) AS lo, min(hi) AS hi
 FROM (SELECT symbol, min(ts) AS lo, max(ts) AS hi FROM usnap GROUP BY symbol UNION ALL SELECT symbol, min(ts), max(ts) FROM signals
 GROUP BY symbol) GROUP BY symbol HAVING count(*) = 2)"""
SHARED["uni"] = """SELECT g.symbol, g.timestamp, coalesce(b.close, 0) AS close,
 CASE WHEN b.timestamp = g.timestamp THEN tick_count ELSE 0 END AS tick_count, coalesce(s.last_signal, 0) AS last_signal,
 coalesce(f.last_fill_price, 0) AS last_fill_price, CASE WHEN f.timestamp = g.timestamp THEN f.n_fills ELSE 0 END AS n_fills,
 hour(g.timestamp) AS hour FROM ugrid g ASOF LEFT JOIN ubars b ON g.symbol = b.symbol AND g.timestamp >= b.timestamp
 ASOF LEFT JOIN sigbars s ON g.symbol = s.symbol AND g.timestamp >= s.timestamp
 ASOF LEFT JOIN fillbars f ON g.symbol = f.symbol AND g.timestamp >= f.timestamp"""


def _unified(v: Views, carry: bool = False) -> DataFrame:
    user = F.concat(F.lit("U"), (F.col("user_id") % 10).cast("string"))
    users = v.table("events").select(F.col("event_id").alias("seq"), user.alias("symbol"))
    snapshots = v.snapshots.drop("symbol").join(users, "seq")
    return datasets.unified(
        "1h",
        snapshots=snapshots,
        signals=v.signals.withColumnRenamed("ts", "timestamp"),
        fills=v.fills.withColumnRenamed("ts", "timestamp"),
        carry_counts=carry,
        orders={"store": ("timestamp", "seq"), "signals": ("timestamp", "signal_id"), "fills": ("timestamp", "fill_id")},
    )


@query("""SELECT symbol, timestamp, R(close) AS close, tick_count, last_signal, R(last_fill_price) AS last_fill_price, n_fills, hour FROM uni""")
def unified(v: Views):
    cols = ["close", "tick_count", "last_signal", "last_fill_price", "n_fills", "hour"]
    return _unified(v).select("symbol", "timestamp", *cols)


@query("""WITH l AS (SELECT *, CAST(lead(close, 5) OVER (PARTITION BY symbol ORDER BY timestamp) > close AS INTEGER) AS label FROM uni),
 k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM l
 WHERE label IS NOT NULL) SELECT symbol, timestamp, label, R(close) AS close,
 CASE WHEN i < n - greatest(1, CAST(floor(n * 0.2::DOUBLE) AS BIGINT)) THEN 'train' ELSE 'val' END AS split FROM k""")
def unified_training(v: Views):
    data = datasets.unified_training_set(_unified(v), "price_direction", 5, lags=(1, 5), windows=(5, 10))
    return data.df.select("symbol", "timestamp", "label", "close", "split")


@query("""SELECT 'order book' AS source, true AS available, 4 AS n_features, count(*) AS n_rows FROM uni UNION ALL
 SELECT 'signals', true, 3, count(*) FROM uni UNION ALL SELECT 'fills', true, 3, count(*) FROM uni""")
def unified_sources(v: Views):
    return datasets.unified_summary(_unified(v))["sources"]


# -- strategy logs -------------------------------------------------------------------------

SHARED["carried"] = """SELECT symbol, ts, last_value(last_fill_price IGNORE NULLS) OVER w AS p, last_value(sum_filled_qty IGNORE NULLS) OVER w AS q
 FROM matrix WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING)"""


@query(f"""WITH k AS (SELECT * FROM carried WHERE p IS NOT NULL), m AS (SELECT *, lead(p, 5) OVER (PARTITION BY symbol ORDER BY ts) AS fut FROM k),
 r AS (SELECT *, (fut - p) / NULLIF(p, 0) AS ret_h FROM m), y AS (SELECT *, {three('ret_h', '5e-4::DOUBLE')} AS y FROM r), z AS (SELECT *,
 row_number() OVER (ORDER BY ts, symbol) - 1 AS i, count(*) OVER () AS n FROM y WHERE y IS NOT NULL)
 SELECT symbol, ts, R(p) AS mid, R(fut) AS future_mid, R(ret_h) AS ret_h, y, R(coalesce(q, 0)) AS sum_filled_qty,
 CASE WHEN i < n - greatest(1, CAST(floor(n * 0.2::DOUBLE) AS BIGINT)) THEN 'train' ELSE 'val' END AS split FROM z""")
def price_move(v: Views):
    data = datasets.price_move_set(v.updates, v.log_fills, "1h", order=("ts", "fill_id"))
    return data.df.select("symbol", "ts", "mid", "future_mid", "ret_h", "y", "sum_filled_qty", "split")


@query("""WITH k AS (SELECT symbol, ts, coalesce(sum_filled_qty, 0) + coalesce(sum_fill_qty, 0) AS q FROM matrix), m AS (SELECT *,
 CASE WHEN count(q) OVER w >= 5 THEN sum(q) OVER w END AS fut FROM k WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 FOLLOWING
 AND 5 FOLLOWING)), z AS (SELECT *, row_number() OVER (ORDER BY ts, symbol) - 1 AS i, count(*) OVER () AS n FROM m WHERE fut IS NOT NULL)
 SELECT symbol, ts, R(q) AS total_fill_qty, R(fut) AS future_fill_sum, CAST(fut > 0 AS INTEGER) AS will_fill,
 CASE WHEN i < n - greatest(1, CAST(floor(n * 0.2::DOUBLE) AS BIGINT)) THEN 'train' ELSE 'val' END AS split FROM z""")
def execution(v: Views):
    data = datasets.execution_set(v.updates, v.log_fills, "1h", order=("ts", "fill_id"))
    return data.df.select("symbol", "ts", "total_fill_qty", "future_fill_sum", "will_fill", "split")


# -- training -------------------------------------------------------------------------------

FEATURES = ["return_1", "price_ma_5", "volume_sum_10", "order_flow_10"]
TICK_ORDER = ["timestamp", "trade_id"]


def _training(v: Views, kind: str = "direction", scaling: str = "standard") -> datasets.Dataset:
    rows = windows.tick_features(ticks(v), order=TICK_ORDER, plain=True)
    return datasets.training_set(rows, kind, 30, features=FEATURES, scaling=scaling, order=TICK_ORDER)


_T = "PARTITION BY symbol ORDER BY timestamp, trade_id"


SHARED["tick_labels"] = f"""SELECT *, CAST(lead(price, 30) OVER o / NULLIF(price, 0) - 1 > 1e-4::DOUBLE AS INTEGER) AS label,
 avg(price) OVER w5 AS ma FROM ticks WINDOW o AS ({_T}), w5 AS ({_T} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""
SHARED["tick_places"] = """SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp, trade_id) - 1 AS i,
 count(*) OVER (PARTITION BY symbol) AS n FROM tick_labels WHERE label IS NOT NULL AND return_1 IS NOT NULL"""
SHARED["tick_split"] = """SELECT *, CASE WHEN i < n - greatest(1, CAST(floor(n * 0.2::DOUBLE) AS BIGINT))
 THEN 'train' ELSE 'val' END AS split FROM tick_places"""


@query("""WITH f AS (SELECT avg(ma) AS c, stddev_pop(ma) AS d FROM tick_split WHERE split = 'train')
 SELECT symbol, timestamp, trade_id, split, label, R((ma - c) / d) AS price_ma_5 FROM tick_split, f""")
def training(v: Views):
    return _training(v).df.select("symbol", "timestamp", "trade_id", "split", "label", "price_ma_5")


@query(f"""WITH f AS (SELECT avg(ma) AS c, stddev_pop(ma) AS d FROM tick_split WHERE split = 'train'), v AS (SELECT symbol, timestamp,
 trade_id, label, (ma - c) / d AS x, row_number() OVER ({_T}) AS place FROM tick_split, f WHERE split = 'val'), w AS (SELECT *,
 lag(x) OVER o AS newest, lag(x, 20) OVER o AS oldest FROM v WINDOW o AS ({_T}))
 SELECT symbol, timestamp, trade_id, label, 20 AS length, R(oldest) AS oldest, R(newest) AS newest FROM w WHERE place > 20""")
def training_sequences(v: Views):
    """The sequences of the validation part: their length and the moving average at both ends."""
    data = _training(v)
    out = datasets.training_sequences(data, "val", 20, order=TICK_ORDER)
    at = data.features.index("price_ma_5")
    ends = {name: F.get(F.element_at("sequence", i), F.lit(at)) for name, i in (("oldest", 1), ("newest", -1))}
    return out.select("symbol", *TICK_ORDER, "label", F.size("sequence").alias("length"), *[c.alias(n) for n, c in ends.items()])


@query()
def model_logistic(v: Views):
    return datasets.experiment(_training(v), "logistic")[1]


@query()
def model_multinomial(v: Views):
    return datasets.experiment(_training(v, "direction_3"), "logistic")[1]


@query()
def model_ridge(v: Views):
    return datasets.experiment(_training(v, "regression"), "ridge")[1]


@query()
def model_forest(v: Views):
    return datasets.experiment(_training(v), "random_forest", trees=10, max_depth=5)[1]


@query()
def model_boosted(v: Views):
    return datasets.experiment(_training(v), "gbt", trees=5, max_depth=3)[1]


@query()
def model_importance(v: Views):
    return datasets.experiment(_training(v), "logistic")[0].importance(v.spark, 3)


@query()
def model_per_symbol(v: Views):
    data = _training(v)
    return models.per_symbol(data.df, data.features)


@query("""WITH s AS (SELECT symbol, count(*) AS n, avg(qty) AS x, avg(price) AS y, sum(qty * price) AS xy, sum(qty * qty) AS xx FROM trades GROUP BY symbol),
 w AS (SELECT symbol, (xy - n * x * y) / (xx - n * x * x + 1) AS slope, x, y FROM s)
 SELECT symbol, R(slope) AS slope, R(y - slope * x) AS intercept FROM w""")
def ridge_per_symbol(v: Views):
    made = models.fit_symbols(v.trades, ["qty"], "price", "ridge").table
    own = F.get("weights", F.lit(0))
    return made.select("symbol", F.get(own, F.lit(0)).alias("slope"), F.get(own, F.lit(1)).alias("intercept"))


@query("""WITH s AS (SELECT symbol, count(*) AS n, avg(qty) AS x, avg(price) AS y, sum(qty * price) AS xy, sum(qty * qty) AS xx FROM trades GROUP BY symbol),
 w AS (SELECT symbol, (xy - n * x * y) / (xx - n * x * x + 1) AS slope, x, y FROM s),
 p AS (SELECT symbol, price, slope * qty + y - slope * x AS said FROM trades JOIN w USING (symbol))
 SELECT symbol, count(*) AS n, R(avg((price - said) ** 2)) AS mse, R(sqrt(avg((price - said) ** 2))) AS rmse, R(avg(abs(price - said))) AS mae,
 R(1 - avg((price - said) ** 2) / var_pop(price)) AS r2, R(avg(CASE WHEN sign(price) = sign(said) THEN 1.0::DOUBLE ELSE 0 END)) AS directional_accuracy
 FROM p GROUP BY symbol""")
def ridge_scored(v: Views):
    made = models.fit_symbols(v.trades, ["qty"], "price", "ridge")
    return metrics.regression_metrics(made.score(v.trades), "price", "prediction", ["symbol"])


# -- reports -----------------------------------------------------------------------------------


def _report_parts(v: Views) -> dict[str | None, list[DataFrame]]:
    """The three splits of each symbol."""
    rows = labels.add_return_labels(hours(v), [5]).dropna(subset=["y_ret_5"])
    made = splits.split_rows(labels.add_direction_labels(rows, [5]))
    made = made.withColumn("ts_ms", F.floor(micros("ts") / 1000).cast("bigint"))
    keep = stage(made.select("symbol", "ts_ms", "close", "volume", "y_ret_5", "y_dir_5", "split"))
    names = [r[0] for r in keep.select("symbol").distinct().orderBy("symbol").collect()]
    own = {name: keep.where(F.col("symbol").eqNullSafe(name)).drop("symbol") for name in names}
    return {name: [df.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")] for name, df in own.items()}


@query()
def split_reports(v: Views):
    """Each symbol is a series of its own: times repeat between symbols."""
    tables = [
        datasets.split_reports(*parts)["targets"].withColumn("symbol", F.lit(name).cast("string"))
        for name, parts in _report_parts(v).items()
    ]
    return union_all(tables)


@query("""SELECT signal_value, count(*) AS n_signals, CAST(sum(had_fill) AS BIGINT) AS n_filled, R(avg(had_fill)) AS fill_rate
 FROM filled GROUP BY signal_value""")
def log_summary(v: Views):
    return datasets.log_summary(v.signals, v.fills, fill_within(v.signals, v.fills, 3600))["fill_rate_signal"]


@query("""SELECT 'volume' AS a, 'volume' AS b, 1.0::DOUBLE AS corr UNION ALL SELECT 'volume', 'num_trades', R(corr(volume, num_trades)) FROM flow
 UNION ALL SELECT 'num_trades', 'num_trades', 1.0::DOUBLE""")
def trade_summary(v: Views):
    table = datasets.trade_summary(flow(v))["correlation"]
    names = ["volume", "num_trades"]
    return table.where(F.col("a").isin(names) & F.col("b").isin(names))
