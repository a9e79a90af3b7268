"""Validation, segments, reports, splits, scaling, metrics and exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickspark.functions.expr import micros
from tickspark.operators import align, bars, explore, metrics, quality, quantiles, scaling, splits
from tickspark.operators.ordered import Ordered
from workload.bars_windows import BOOK_KEY, EVENT, SEG, flow, fill_bars, rounded, segmented, signal_bars
from workload.registry import SHARED, query
from workload.views import Views

# -- validation and segments ------------------------------------------------------------


SHARED["judged"] = """SELECT *, CASE WHEN bid_px IS NULL OR ask_px IS NULL OR bid_qty IS NULL OR ask_qty IS NULL OR
 vol_base IS NULL OR ts IS NULL THEN 'dropped_null' WHEN NOT (bid_px > 0 AND ask_px > 0 AND bid_qty >= 0 AND ask_qty >= 0
 AND vol_base >= 0) THEN 'dropped_nonpositive' WHEN bid_px > ask_px THEN 'dropped_crossed' END AS why
 FROM (SELECT symbol, ts, seq, bid_px - 2 AS bid_px, CASE WHEN seq % 17 = 0 THEN bid_px - 3 ELSE ask_px END AS ask_px,
 CASE WHEN seq % 13 = 0 THEN NULL ELSE bid_qty END AS bid_qty, ask_qty, vol_base FROM book)"""


def dirty_book(v: Views):
    """The book with some missing sizes, crossed quotes and low prices."""
    return v.book.withColumns(
        {
            "ask_px": F.when(F.col("seq") % 17 == 0, F.col("bid_px") - 3).otherwise(F.col("ask_px")),
            "bid_px": F.col("bid_px") - 2,
            "bid_qty": F.when(F.col("seq") % 13 != 0, F.col("bid_qty")),
        }
    )


@query("""SELECT count(*) AS total_rows, count(*) FILTER (why = 'dropped_null') AS dropped_null,
 count(*) FILTER (why = 'dropped_nonpositive') AS dropped_nonpositive, count(*) FILTER (why = 'dropped_crossed') AS dropped_crossed,
 count(*) FILTER (why IS NULL) AS kept_rows, (SELECT count(*) FROM (SELECT epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY
 symbol ORDER BY ts, seq) AS g FROM judged WHERE why IS NULL) WHERE g <> 1000000) AS dt_anomalies FROM judged""")
def validate(v: Views):
    return quality.book_report(dirty_book(v), order=BOOK_KEY, plain=True)


@query("SELECT symbol, ts, seq, R(bid_px) AS bid_px, R(ask_px) AS ask_px FROM judged WHERE why IS NULL")
def validated(v: Views):
    return quality.clean_book(dirty_book(v)).select("symbol", "ts", "seq", "bid_px", "ask_px")


@query("SELECT symbol, ts, seq, segment_id FROM segs")
def segments(v: Views):
    return segmented(v).select("symbol", "ts", "seq", "segment_id")


# On hourly bars a missing hour is a gap.
SHARED["hourly"] = """SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY ts) AS gap FROM ohlcv"""
SHARED["hourseg"] = """SELECT *, CAST(sum(CASE WHEN gap = 3600000000 THEN 0 ELSE 1 END) OVER (PARTITION BY symbol ORDER BY ts
 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_id FROM hourly"""


def hours(v: Views):
    return bars.ohlcv_bars(v.trades, "1h", order=EVENT)


@query("SELECT symbol, ts, segment_id FROM hourseg")
def segments_exact(v: Views):
    return quality.add_segments(hours(v), "1h").select("symbol", "ts", "segment_id")


@query("""WITH k AS (SELECT symbol, ts FROM hourly WHERE gap IS NULL OR gap = 3600000000), g AS (SELECT *, epoch_us(ts) -
 lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY ts) AS gap FROM k) SELECT symbol, ts, CAST(sum(CASE WHEN gap = 3600000000
 THEN 0 ELSE 1 END) OVER (PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_id FROM g""")
def segments_drop(v: Views):
    return quality.add_segments(hours(v), "1h", "drop").select("symbol", "ts", "segment_id")


@query("""WITH s AS (SELECT symbol, min(ts) AS lo, max(ts) AS hi FROM ohlcv GROUP BY symbol), g AS (SELECT symbol,
 unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM s), m AS (SELECT g.symbol, g.ts, o.close FROM g LEFT JOIN ohlcv o
 ON g.symbol = o.symbol AND g.ts = o.ts) SELECT symbol, ts, R(last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY
 ts ROWS UNBOUNDED PRECEDING)) AS close, 1 AS segment_id FROM m""")
def segments_reindex(v: Views):
    rows = hours(v).select("symbol", "ts", "close")
    return quality.add_segments(rows, "1h", "reindex_fill")


@query("""SELECT symbol, ts, segment_id FROM hourseg SEMI JOIN (SELECT symbol, segment_id FROM hourseg GROUP BY ALL
 HAVING count(*) >= 3) USING (symbol, segment_id)""")
def segments_long(v: Views):
    out = quality.drop_short_segments(quality.add_segments(hours(v), "1h"), 3)
    return out.select("symbol", "ts", "segment_id")


@query("SELECT symbol, ts, seq FROM judged WHERE bid_qty IS NOT NULL AND abs(bid_px) < 1e308::DOUBLE")
def drop_null(v: Views):
    return quality.drop_null_rows(dirty_book(v), ["bid_qty", "bid_px"], finite=True).select("symbol", "ts", "seq")


@query("""SELECT symbol, ts, R(c) AS price_change_pct FROM (SELECT symbol, ts, close / NULLIF(lag(close) OVER (PARTITION BY symbol
 ORDER BY ts), 0) - 1 AS c FROM ohlcv) WHERE abs(c) < 1""")
def outliers(v: Views):
    moved = Ordered(hours(v), ["symbol"], ["ts"]).windows(
        lambda d, w: d.withColumn("price_change_pct", F.try_divide("close", F.lag("close").over(w)) - 1), back=1
    )
    return quality.drop_outliers(moved).select("symbol", "ts", "price_change_pct")


SHARED["timed"] = "SELECT epoch_us(ts) // 1000 AS ts_ms, value, user_id, 1 AS constant FROM events"


def timed(v: Views):
    ms = F.floor(micros("ts") / 1000).cast("bigint")
    return v.table("events").select(ms.alias("ts_ms"), "value", "user_id", F.lit(1).alias("constant"))


@query("""WITH d AS (SELECT ts_ms, ts_ms - lag(ts_ms) OVER (ORDER BY ts_ms) AS dt FROM timed) SELECT
 (SELECT count(*) FROM timed) AS rows, 0 AS rows_with_null, 0 AS rows_with_inf, (SELECT min(ts_ms) FROM timed) AS ts_min,
 (SELECT max(ts_ms) FROM timed) AS ts_max, (SELECT count(*) - count(DISTINCT ts_ms) FROM timed) AS ts_duplicates,
 min(dt) AS dt_min, R(quantile_cont(dt, 0.5)) AS dt_median, max(dt) AS dt_max,
 R(100 * avg(CASE WHEN dt = 1000 THEN 1.0::DOUBLE ELSE 0 END) FILTER (dt IS NOT NULL)) AS pct_dt_expected, 'constant' AS constant_cols,
 'constant' AS near_constant_cols FROM d""")
def quality_report(v: Views):
    out = quality.quality_report(timed(v), strict=False, plain=True)
    return out.withColumns({c: F.concat_ws(",", c) for c in ("constant_cols", "near_constant_cols")})


@query("""SELECT 'value' AS "column", R(quantile_cont(value, 0.001)) AS q_low, R(quantile_cont(value, 0.999)) AS q_high FROM timed
 UNION ALL SELECT 'user_id', R(quantile_cont(user_id, 0.001)), R(quantile_cont(user_id, 0.999)) FROM timed""")
def outlier_bounds(v: Views):
    return quality.outlier_bounds(timed(v), ["value", "user_id"])


@query("""SELECT count(*) FILTER (b) = 0 AS ts_monotonic_increasing, count(*) FILTER (b) AS steps_back FROM
 (SELECT epoch_us(ts) < lag(epoch_us(ts)) OVER (ORDER BY event_id) AS b FROM events)""")
def arrival_order(v: Views):
    rows = v.table("events").select("event_id", micros("ts").alias("t"))
    return quality.is_sorted(rows, "event_id", "t", plain=True)


SHARED["numbered"] = """SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY symbol)
 AS n FROM ohlcv"""
SHARED["cut"] = """SELECT *, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS te, CAST(floor(n * 0.15::DOUBLE) AS BIGINT) AS w FROM numbered"""
SHARED["parts"] = """SELECT *, CASE WHEN i < te THEN 'train' WHEN i >= te + 60 AND i < te + 60 + w THEN 'val'
 WHEN i >= te + 120 + w THEN 'test' END AS split FROM cut"""


@query("SELECT symbol, ts, split FROM parts WHERE split IS NOT NULL")
def split_rows(v: Views):
    return splits.split_rows(hours(v)).select("symbol", "ts", "split")


@query("""SELECT symbol, ts, CASE WHEN i < te THEN 'train' WHEN i >= te + 10 AND i < te + 10 + w THEN 'val' ELSE 'test' END AS split
 FROM (SELECT *, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS te, CAST(floor(n * 0.2::DOUBLE) AS BIGINT) AS w FROM numbered)
 WHERE i < te OR (i >= te + 10 AND i < te + 10 + w) OR i >= te + 20 + w""")
def split_three(v: Views):
    # 1 - 0.2 - 0.1 differs from 0.7 in the last bit, as in any implementation.
    return splits.split_rows(hours(v), 0.7, 0.2, 10).select("symbol", "ts", "split")


@query(f"""WITH p AS (SELECT *, row_number() OVER ({SEG}) - 1 AS i, count(*) OVER (PARTITION BY symbol, segment_id) AS n FROM segs),
 q AS (SELECT *, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train' WHEN i < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE)
 THEN 'val' ELSE 'test' END AS split FROM p),
 l AS (SELECT symbol, segment_id, max(epoch_us(ts)) FILTER (split = 'train') AS a, max(epoch_us(ts)) FILTER (split = 'val') AS b
 FROM q GROUP BY ALL)
 SELECT q.symbol, q.ts, q.seq, q.segment_id, q.split FROM q JOIN l USING (symbol, segment_id) WHERE split = 'train'
 OR (split = 'val' AND (a IS NULL OR epoch_us(ts) > a + 60000000)) OR (split = 'test' AND (coalesce(CASE WHEN a IS NULL OR
 b > a + 60000000 THEN b END, a) IS NULL OR epoch_us(ts) > coalesce(CASE WHEN a IS NULL OR b > a + 60000000 THEN b END, a) + 60000000))""")
def split_segment(v: Views):
    return splits.split_segments(segmented(v)).select("symbol", "ts", "seq", "segment_id", "split")


@query("""WITH p AS (SELECT symbol, ts, row_number() OVER (ORDER BY ts, symbol) - 1 AS i, count(*) OVER () AS n FROM ohlcv)
 SELECT symbol, ts, CASE WHEN i < n - greatest(1, CAST(floor(n * 0.2::DOUBLE) AS BIGINT)) THEN 'train' ELSE 'val' END AS split FROM p""")
def split_time(v: Views):
    return splits.split_time(hours(v), order=["ts", "symbol"]).select("symbol", "ts", "split")


_UNIT = "CAST(concat('0x', substr(md5(concat('42|', trade_id)), 1, 13)) AS BIGINT) / 4503599627370496::DOUBLE"


@query(f"SELECT symbol, trade_id, CASE WHEN {_UNIT} < 0.2::DOUBLE THEN 'val' ELSE 'train' END AS split FROM trades")
def split_hash(v: Views):
    return splits.split_hash(v.trades, ["trade_id"], 0.2).select("symbol", "trade_id", "split")


@query(f"SELECT symbol, ts, trade_id, R(price) AS price, R(qty) AS qty, is_buyer_maker FROM trades WHERE {_UNIT} < 0.1::DOUBLE")
def sample_hash(v: Views):
    return splits.sample_hash(v.trades, ["trade_id"], 0.1)


@query("SELECT symbol, ts, trade_id, R(price) AS price FROM trades ORDER BY ts DESC, trade_id DESC LIMIT 500")
def last_n(v: Views):
    return splits.last_n(v.trades, 500, EVENT).select("symbol", "ts", "trade_id", "price")


@query("""SELECT symbol, ts, trade_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) - 1 AS i,
 count(*) OVER (PARTITION BY symbol) AS n FROM trades) WHERE i % greatest(1, n // 300) = 0""")
def systematic(v: Views):
    return splits.systematic(v.trades, 300, order=EVENT, plain=True).select("symbol", "ts", "trade_id")


@query("""SELECT symbol, ts, R(close) AS close FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i,
 count(*) OVER (PARTITION BY symbol) AS n FROM ohlcv) WHERE i % greatest(1, n // 100) = 0""")
def plot_series(v: Views):
    return explore.plot_series(hours(v), ["close"], 100)


@query("""SELECT * FROM (SELECT min(ts) FILTER (split = 'train') AS train_min, max(ts) FILTER (split = 'train') AS train_max,
 min(ts) FILTER (split = 'val') AS val_min, max(ts) FILTER (split = 'val') AS val_max, min(ts) FILTER (split = 'test') AS test_min,
 max(ts) FILTER (split = 'test') AS test_max FROM (SELECT epoch_us(ts) AS ts, split FROM parts WHERE symbol = 'click' AND split
 IS NOT NULL)), LATERAL (SELECT train_max >= val_min AS train_val_overlap, val_max >= test_min AS val_test_overlap,
 val_min - train_max AS gap_train_to_val, test_min - val_max AS gap_val_to_test)""")
def split_compare(v: Views):
    rows = splits.split_rows(hours(v)).where(F.col("symbol") == "click").select(micros("ts").alias("t"), "split")
    return quality.compare_splits(*[rows.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")], "t")


@query("""SELECT * FROM (SELECT symbol, min(ts) FILTER (split = 'train') AS train_min, max(ts) FILTER (split = 'train') AS train_max,
 min(ts) FILTER (split = 'val') AS val_min, max(ts) FILTER (split = 'val') AS val_max, min(ts) FILTER (split = 'test') AS test_min,
 max(ts) FILTER (split = 'test') AS test_max FROM (SELECT symbol, epoch_us(ts) AS ts, split FROM parts WHERE split IS NOT NULL)
 GROUP BY symbol), LATERAL (SELECT train_max >= val_min AS train_val_overlap, val_max >= test_min AS val_test_overlap,
 val_min - train_max AS gap_train_to_val, test_min - val_max AS gap_val_to_test)""")
def split_compare_symbols(v: Views):
    """Each symbol's splits; ``split_compare`` and its SQL look at one."""
    rows = splits.split_rows(hours(v)).select("symbol", micros("ts").alias("t"), "split")
    return quality.compare_splits(
        *[rows.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")], "t", by=["symbol"]
    )


@query("""SELECT split, count(DISTINCT CASE WHEN close > open THEN 1 ELSE 0 END) AS classes FROM parts WHERE split IS NOT NULL
 GROUP BY split""")
def class_guard(v: Views):
    rows = splits.split_rows(hours(v)).withColumn("label", (F.col("close") > F.col("open")).cast("int"))
    return quality.require_classes(rows)


@query("""SELECT count(*) AS n_rows, string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols, min(timestamp) AS start,
 max(timestamp) AS "end", R(min(mid_price)) AS min_mid, R(max(mid_price)) AS max_mid, R(avg(spread_bps)) AS avg_spread_bps FROM snap""")
def store_summary(v: Views):
    return quality.store_summary(v.snapshots).withColumn("symbols", F.concat_ws(",", "symbols"))


@query("""SELECT 'signals' AS source, true AS available, 2 AS n_features, count(*) FILTER (last_signal IS NOT NULL) AS n_rows FROM sigbars
 UNION ALL SELECT 'fills', false, 0, 0""")
def source_availability(v: Views):
    sources = {"signals": ["last_signal", "n_signals"], "fills": ["fill_volume"]}
    return quality.source_availability(signal_bars(v).drop("n_signals").withColumn("n_signals", F.lit(None).cast("bigint")), sources)


@query("SELECT symbol, ts, trade_id FROM trades WHERE symbol IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'")
def filter_window(v: Views):
    rows = v.trades.where(F.col("symbol").isin("click", "view"))
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-20"))
    return rows.where((F.col("ts") >= lo) & (F.col("ts") < hi)).select("symbol", "ts", "trade_id")


# -- sets ------------------------------------------------------------------------------------


@query("SELECT trade_id, R(price * qty) AS notional FROM trades ORDER BY price * qty DESC, trade_id LIMIT 20")
def topk(v: Views):
    notional = F.col("price") * F.col("qty")
    return v.trades.select("trade_id", notional.alias("notional")).orderBy(F.desc("notional"), "trade_id").limit(20)


@query("SELECT symbol, ts, trade_id FROM trades ORDER BY symbol, ts, trade_id LIMIT 100")
def head(v: Views):
    return v.trades.select("symbol", "ts", "trade_id").orderBy("symbol", "ts", "trade_id").limit(100)


@query("SELECT DISTINCT symbol, is_buyer_maker FROM lines")
def distinct(v: Views):
    return v.lines.select("symbol", "is_buyer_maker").distinct()


@query("SELECT symbol, ts, count(*) AS copies FROM lines GROUP BY symbol, ts HAVING count(*) > 1")
def duplicate_keys(v: Views):
    return v.lines.groupBy("symbol", "ts").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


@query("SELECT DISTINCT symbol, ts FROM (SELECT symbol, ts FROM trades UNION ALL SELECT symbol, ts FROM trades)")
def dedup(v: Views):
    twice = v.trades.unionByName(v.trades)
    return twice.dropDuplicates(["symbol", "ts"]).select("symbol", "ts")


# -- scaling ----------------------------------------------------------------------------------


def _scaled(v: Views, method: str):
    rows = splits.split_rows(hours(v))
    out, _ = scaling.fit_transform(rows, ["close", "volume", "num_trades"], method)
    return out.select("symbol", "ts", "split", "close", "volume", "num_trades")


def _scale_sql(centre: str, spread: str) -> str:
    cols = ("close", "volume", "num_trades")
    fitted = ", ".join(f"{centre.format(c)} AS c_{c}, {spread.format(c)} AS s_{c}" for c in cols)
    made = ", ".join(f"R(({c} - c_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END) AS {c}" for c in cols)
    return f"""WITH f AS (SELECT {fitted} FROM parts WHERE split = 'train') SELECT symbol, ts, split, {made} FROM parts, f
 WHERE split IS NOT NULL"""


@query(_scale_sql("avg({})", "stddev_pop({})"))
def scale_standard(v: Views):
    return _scaled(v, "standard")


@query(_scale_sql("quantile_cont({}, 0.5)", "quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)"))
def scale_robust(v: Views):
    return _scaled(v, "robust")


@query(_scale_sql("min({})", "max({0}) - min({0})"))
def scale_minmax(v: Views):
    return _scaled(v, "minmax")


@query(_scale_sql("0 * min({})", "stddev_pop({})"))
def scale_nocentre(v: Views):
    return _scaled(v, "scale_only")


@query("""SELECT 'standard' AS method, i AS position, f AS feature, R(c) AS centre, R(s) AS scale FROM (
 SELECT 0 AS i, 'close' AS f, avg(close) AS c, stddev_pop(close) AS s FROM parts WHERE split = 'train' UNION ALL
 SELECT 1, 'volume', avg(volume), stddev_pop(volume) FROM parts WHERE split = 'train')""")
def scaler_params(v: Views):
    train = splits.split_rows(hours(v)).where(F.col("split") == "train")
    return scaling.fit_scaler(train, ["close", "volume"]).table(v.spark)


# -- metrics -----------------------------------------------------------------------------------

SHARED["conf"] = "SELECT CAST(quality AS DOUBLE) AS t, CAST(toxic AS DOUBLE) AS p FROM labels"
SHARED["perclass"] = """SELECT c, count(*) FILTER (t = c) AS support, count(*) FILTER (p = c) AS said, count(*) FILTER (t = c AND p = c)
 AS hit, count(*) AS n FROM conf, (SELECT DISTINCT t AS c FROM conf UNION SELECT DISTINCT p FROM conf) GROUP BY c"""


@query("""SELECT max(n) AS n, R(sum(hit) / max(n)) AS accuracy, R(sum(support * coalesce(hit / NULLIF(said, 0), 0)) / sum(support)) AS "precision",
 R(sum(support * coalesce(hit / NULLIF(support, 0), 0)) / sum(support)) AS recall,
 R(sum(support * coalesce(2 * hit / NULLIF(said + support, 0), 0)) / sum(support)) AS f1 FROM perclass""")
def metrics_cls(v: Views):
    return metrics.classification_metrics(v.table("labels"), "quality", "toxic")


def _scored(v: Views):
    docs = v.table("documents").select("doc_id", "n_chars")
    p = F.try_divide(F.col("n_chars") % 1000, F.lit(1000.0))
    return v.table("labels").join(docs, "doc_id").withColumns({"p1": 0.001 + 0.99 * p, "p0": 0.999 - 0.99 * p})


SHARED["scored"] = """SELECT quality, 0.001::DOUBLE + 0.99::DOUBLE * ((n_chars % 1000) / 1000.0::DOUBLE) AS p1, 0.999::DOUBLE - 0.99::DOUBLE
 * ((n_chars % 1000) / 1000.0::DOUBLE) AS p0 FROM labels JOIN documents USING (doc_id)"""


@query("""WITH r AS (SELECT quality, rank() OVER (ORDER BY p1) + (count(*) OVER (PARTITION BY p1) - 1) / 2.0 AS rnk FROM scored)
 SELECT R((sum(rnk) FILTER (quality = 1) - count(*) FILTER (quality = 1) * (count(*) FILTER (quality = 1) + 1) / 2.0::DOUBLE)
 / (count(*) FILTER (quality = 1) * count(*) FILTER (quality = 0))) AS auc FROM r""")
def auc(v: Views):
    return metrics.auc(_scored(v), F.col("quality") == 1, "p1")


@query("""WITH r AS (SELECT quality AS y, rank() OVER (ORDER BY p1) + (count(*) OVER (PARTITION BY p1) - 1) / 2.0 AS r1,
 rank() OVER (ORDER BY p0) + (count(*) OVER (PARTITION BY p0) - 1) / 2.0 AS r0 FROM scored),
 s AS (SELECT count(*) FILTER (y = 1) AS a, count(*) FILTER (y = 0) AS b, sum(r1) FILTER (y = 1) AS s1, sum(r0) FILTER (y = 0) AS s0 FROM r)
 SELECT R(((s1 - a * (a + 1) / 2.0::DOUBLE) / (a * b) + (s0 - b * (b + 1) / 2.0::DOUBLE) / (a * b)) / 2) AS auc FROM s""")
def auc_ovr(v: Views):
    return metrics.auc_ovr(_scored(v), "quality", {0: "p0", 1: "p1"})


@query("SELECT R(-avg(ln(CASE WHEN quality = 1 THEN p1 ELSE p0 END))) AS log_loss FROM scored")
def log_loss(v: Views):
    return metrics.log_loss(_scored(v), "quality", {0: "p0", 1: "p1"})


@query("""WITH o AS (SELECT o_totalprice AS y, CAST(o_custkey AS DOUBLE) * 100 AS p FROM orders) SELECT count(*) AS n,
 R(avg((y - p) * (y - p)) / 1e9::DOUBLE) AS mse_e9, R(sqrt(avg((y - p) * (y - p))) / 1e3::DOUBLE) AS rmse_e3,
 R(avg(abs(y - p)) / 1e3::DOUBLE) AS mae_e3, R(1 - avg((y - p) * (y - p)) / var_pop(y)) AS r2,
 R(avg(CASE WHEN sign(y) = sign(p) THEN 1.0::DOUBLE ELSE 0 END)) AS directional_accuracy FROM o""")
def metrics_reg(v: Views):
    rows = v.table("orders").select(F.col("o_totalprice").alias("y"), (F.col("o_custkey").cast("double") * 100).alias("p"))
    m = metrics.regression_metrics(rows, "y", "p")
    big = {"mse": 9, "rmse": 3, "mae": 3}
    return m.select("n", *[(F.col(c) / 10.0**e).alias(f"{c}_e{e}") for c, e in big.items()], "r2", "directional_accuracy")


@query("""SELECT R(avg(price * price)) AS mse_pred0, (SELECT R(avg(abs(price - m))) FROM trades, (SELECT avg(price) AS m FROM trades))
 AS mae_predmean, (SELECT R(max(n) / sum(n)) FROM (SELECT count(*) AS n FROM trades GROUP BY symbol)) AS acc_majority,
 (SELECT R(1.0 / count(DISTINCT symbol)) FROM trades) AS bal_acc_majority FROM trades""")
def baselines(v: Views):
    zero, mean = metrics.zero_mse(v.trades, "price"), metrics.mean_mae(v.trades, "price")
    major = metrics.majority_baseline(v.trades, "symbol")
    return major.withColumns({"mse_pred0": zero.scalar(), "mae_predmean": mean.scalar()})


# -- exploration ------------------------------------------------------------------------------------


def _stats_sql(table: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", R(avg({c})) AS mean, R(stddev_samp({c})) AS std, R(min({c})) AS min, R(max({c})) AS max,
 R(quantile_cont({c}, 0.01)) AS q01, R(quantile_cont({c}, 0.5)) AS q50, R(quantile_cont({c}, 0.99)) AS q99 FROM {table}"""
        for c in columns
    )


@query(_stats_sql("trades", "price", "qty"))
def target_stats(v: Views):
    return explore.target_stats(v.trades, ["price", "qty"])


@query("""SELECT "class", n, R(n / sum(n) OVER ()) AS share FROM (SELECT symbol AS "class", count(*) AS n FROM trades GROUP BY symbol)""")
def class_share(v: Views):
    return explore.class_share(v.trades, "symbol")


@query("""WITH b AS (SELECT min(price) AS lo, (max(price) - min(price)) / 20 AS w FROM trades), h AS (SELECT symbol,
 CAST(least(floor((price - lo) / w), 19) AS BIGINT) AS bin, lo, w FROM trades, b)
 SELECT symbol, bin, count(*) AS n, R(lo + bin * w) AS bin_start FROM h GROUP BY symbol, bin, lo, w""")
def histogram(v: Views):
    return explore.histogram(v.trades, "price", 20, by=["symbol"])


@query("""WITH r AS (SELECT rank() OVER (ORDER BY price) + (count(*) OVER (PARTITION BY price) - 1) / 2.0::DOUBLE AS p,
 rank() OVER (ORDER BY qty) + (count(*) OVER (PARTITION BY qty) - 1) / 2.0::DOUBLE AS q FROM trades)
 SELECT 'price' AS a, 'price' AS b, 1.0::DOUBLE AS corr UNION ALL SELECT 'price', 'qty', R(corr(p, q)) FROM r
 UNION ALL SELECT 'qty', 'qty', 1.0::DOUBLE""")
def spearman(v: Views):
    return explore.spearman(v.trades, ["price", "qty"])


_RANKED = ["price", "qty", "l_partkey", "l_suppkey"]
_RANKS = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in _RANKED)
_PAIRS = [(a, b) for i, a in enumerate(_RANKED) for b in _RANKED[i:]]


@query(
    f"WITH r AS (SELECT {_RANKS} FROM lines WHERE price IS NOT NULL AND qty IS NOT NULL AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL) "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, R(corr({a}, {b})) AS corr FROM r" for a, b in _PAIRS)
)
def spearman_lines(v: Views):
    return explore.spearman(v.lines, _RANKED)


@query("""SELECT 'volume' AS a, 'close' AS b, R(corr(volume, close)) AS corr FROM flow UNION ALL
 SELECT 'volume', 'log_return', R(corr(volume, log_return)) FROM flow UNION ALL
 SELECT 'num_trades', 'close', R(corr(num_trades, close)) FROM flow UNION ALL
 SELECT 'num_trades', 'log_return', R(corr(num_trades, log_return)) FROM flow""")
def pearson(v: Views):
    return explore.pearson(flow(v), ["volume", "num_trades"], ["close", "log_return"])


@query(" UNION ALL ".join(f"SELECT '{n}' AS statistic, R({f.format('price')}) AS price, R({f.format('qty')}) AS qty FROM trades" for n, f in {
    "count": "count({})", "mean": "avg({})", "std": "stddev_samp({})", "min": "min({})", "1%": "quantile_cont({}, 0.01)",
    "50%": "quantile_cont({}, 0.5)", "99%": "quantile_cont({}, 0.99)", "max": "max({})"}.items()))
def describe(v: Views):
    return explore.describe(v.trades, ["price", "qty"])


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) AS n, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS "distinct",
 R(min({c})) AS min, R(max({c})) AS max, R(avg({c})) AS mean, R(stddev_samp({c})) AS std, count(*) FILTER ({c} = 0) AS zeros FROM trades"""
 for c in ("price", "qty")))
def profile(v: Views):
    return explore.profile(v.trades, ["price", "qty"])


SHARED["filled"] = """SELECT s.*, CASE WHEN epoch_us(f.ts) - epoch_us(s.ts) <= 3600000000 THEN 1 ELSE 0 END AS had_fill
 FROM signals s ASOF LEFT JOIN fills f ON s.symbol = f.symbol AND s.ts <= f.ts"""


def labelled_signals(v: Views):
    return align.fill_within(v.signals, v.fills, 3600)


@query("SELECT symbol, count(*) AS n_signals, CAST(sum(had_fill) AS BIGINT) AS n_filled, R(avg(had_fill)) AS fill_rate FROM filled GROUP BY symbol")
def fill_rate(v: Views):
    return explore.fill_rate(labelled_signals(v), "symbol")


@query("""SELECT signal_value, count(*) AS n_signals, CAST(sum(had_fill) AS BIGINT) AS n_filled, R(avg(had_fill)) AS fill_rate
 FROM filled GROUP BY signal_value""")
def fill_rate_by_signal(v: Views):
    return explore.fill_rate(labelled_signals(v), "signal_value")


@query("SELECT strategy_id, signal_value, count(*) AS n FROM signals GROUP BY ALL")
def signal_by_strategy(v: Views):
    return explore.signal_counts(v.signals, "strategy_id", "signal_value")


@query("""SELECT last_signal, R(sum(fill_volume)) AS fill_volume, count(*) AS n FROM fillbars f ASOF LEFT JOIN sigbars s
 ON f.symbol = s.symbol AND f.timestamp >= s.timestamp GROUP BY last_signal""")
def fills_by_signal(v: Views):
    right = signal_bars(v).select("symbol", "timestamp", "last_signal")
    return explore.fill_volume_by_signal(align.asof_join(fill_bars(v), right, on="timestamp"))


@query("SELECT hour(ts) AS hour, R(avg(log_return)) AS mean_return, count(log_return) AS n FROM flow GROUP BY hour(ts)")
def hourly_return(v: Views):
    return explore.hourly_return(flow(v))


@query("""SELECT symbol, count(*) AS n_bars, min(ts) AS start, max(ts) AS "end", R(sum(volume)) AS volume,
 CAST(sum(num_trades) AS BIGINT) AS num_trades, R(avg(log_return)) AS mean_return, R(stddev_samp(log_return)) AS std_return
 FROM flow GROUP BY symbol""")
def symbol_summary(v: Views):
    return explore.symbol_summary(flow(v))


@query("""SELECT split, count(*) AS rows, 2 AS n_features, 'false:' || count(*) FILTER (NOT close > open) || ',true:' ||
 count(*) FILTER (close > open) AS label_distribution FROM parts WHERE split IS NOT NULL GROUP BY split""")
def dataset_summary(v: Views):
    rows = splits.split_rows(hours(v)).withColumn("label", F.col("close") > F.col("open"))
    out = explore.dataset_summary(rows, ["close", "volume"])
    pairs = F.transform(F.map_entries("label_distribution"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return out.withColumn("label_distribution", F.concat_ws(",", F.array_sort(pairs)))


@query("""SELECT 'price' AS "column", R(0.1) AS prob, R(quantile_cont(price, 0.1)) AS value FROM trades UNION ALL
 SELECT 'price', R(0.9), R(quantile_cont(price, 0.9)) FROM trades""")
def quantile_table(v: Views):
    return quantiles.quantile_table(v.trades, ["price"], [0.1, 0.9])
