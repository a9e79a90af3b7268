"""Readers. Every reader takes an explicit schema, so nothing is inferred, and
returns a lazy frame whose files Spark reads in parallel."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark import schemas
from tickspark.functions.expr import EPS_BARS, div, epoch_to_ts, ln, parse_ts, snapshot_features
from tickspark.session import stage

CORRUPT = "_corrupt_record"
LINES_PER_BATCH = 50_000

# Folders of the public file layout.
_MARKET_PATH = {"spot": "spot", "um": "futures/um", "cm": "futures/cm"}


# -- public zipped files ---------------------------------------------------------------


def zip_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, line, error): the lines of the first CSV member of each archive. An
    unreadable archive gives one row with ``error`` and no line. Spark has no zip
    codec, so tasks unpack; parsing the lines stays in Spark."""

    def unpack(batches: Iterator) -> Iterator:
        import io
        import zipfile
        from itertools import islice

        import pandas as pd

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    archive = zipfile.ZipFile(io.BytesIO(content))
                    member = next(n for n in archive.namelist() if n.endswith(".csv"))
                    with io.TextIOWrapper(archive.open(member), "utf-8", errors="replace") as text:
                        while lines := [x.rstrip("\r\n") for x in islice(text, LINES_PER_BATCH)]:
                            yield pd.DataFrame({"path": path, "line": lines, "error": None})
                except (zipfile.BadZipFile, StopIteration, OSError, EOFError) as e:
                    yield pd.DataFrame({"path": [path], "line": [None], "error": [repr(e)]})

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(unpack, "path string, line string, error string")


def file_date(path: Column | str) -> Column:
    """Date in a file name ``...-YYYY-MM-DD.zip`` or ``...-YYYY-MM.zip``."""
    path = F.col(path) if isinstance(path, str) else path
    part = F.regexp_extract(path, r"-(\d{4}-\d{2}(?:-\d{2})?)\.[A-Za-z.]+$", 1)
    return F.when(F.length(part) == 7, F.concat(part, F.lit("-01"))).otherwise(part).try_cast("date")


def list_public_files(
    spark: SparkSession,
    base: str,
    symbol: str = "*",
    kind: str = "trades",
    market: str = "spot",
    interval: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """(path, symbol, file_date) of archives in ``market/type/symbol[/interval]``,
    within an inclusive date range. File contents are not read."""
    if market not in _MARKET_PATH:
        raise ValueError(f"unknown market: {market}")
    if kind == "klines" and not interval:
        raise ValueError("klines need an interval")
    folder = f"{base.rstrip('/')}/{_MARKET_PATH[market]}/{kind}/{symbol}"
    if kind == "klines":
        folder += f"/{interval}"
    found = spark.read.format("binaryFile").load(f"{folder}/*.zip").select("path")
    name = F.regexp_extract("path", rf"/{kind}/([^/]+)/", 1)
    out = found.select("path", name.alias("symbol"), file_date("path").alias("file_date"))
    if start:
        out = out.where(F.col("file_date") >= F.lit(start))
    if end:
        out = out.where(F.col("file_date") <= F.lit(end))
    return out


def read_public(
    spark: SparkSession,
    paths: str | Sequence[str],
    kind: str = "trades",
    market: str = "spot",
    symbol: str | None = None,
) -> DataFrame:
    """Public archives with derived columns. Malformed cells are NULL and the line
    is kept in ``_corrupt_record``; unreadable archives are skipped (``zip_lines``
    lists them). The symbol comes from the file name unless given."""
    schema = schemas.public_schema(market, kind)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = zip_lines(spark, paths).where(F.col("line").isNotNull() & (F.trim("line") != ""))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
    options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    rows = lines.select("path", F.from_csv("line", ddl, options).alias("r"))
    named = F.lit(symbol) if symbol else F.regexp_extract("path", r"([^/]+?)-[^/]*$", 1)
    rows = rows.select("r.*", named.alias("symbol"), file_date("path").alias("file_date"))
    return _derived(rows, kind, market)


def _derived(rows: DataFrame, kind: str, market: str) -> DataFrame:
    day = F.col("file_date")
    if kind == "klines":
        made = {
            "ts": epoch_to_ts("open_time", day, market),
            "close_ts": epoch_to_ts("close_time", day, market),
            "log_return": ln(div("close", "open")),
            "range": F.col("high") - F.col("low"),
            "range_pct": div(F.col("high") - F.col("low"), "open"),
            "typical_price": (F.col("high") + F.col("low") + F.col("close")) / 3,
            "taker_buy_ratio": div("taker_buy_base_volume", F.col("volume") + EPS_BARS),
        }
        return rows.withColumns(made).drop("ignore", "file_date")
    made = {
        "ts": epoch_to_ts("time", day, market),
        "side": F.when(F.col("is_buyer_maker"), "SELL").otherwise("BUY"),
    }
    if kind == "aggTrades":
        made["num_trades"] = F.col("last_trade_id") - F.col("first_trade_id") + 1
    return rows.withColumns(made).drop("file_date")


def load_public(
    spark: SparkSession,
    base: str,
    symbol: str = "*",
    kind: str = "trades",
    market: str = "spot",
    interval: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Every archive of the layout within the dates. Only the names of the matching
    files pass through the driver, as they do in any file scan."""
    files = list_public_files(spark, base, symbol, kind, market, interval, start, end)
    paths = [r["path"] for r in files.collect()]
    if not paths:
        raise FileNotFoundError(f"no {kind} files for {symbol} under {base}")
    return read_public(spark, paths, kind, market, None if symbol == "*" else symbol)


# -- order-book snapshots ----------------------------------------------------------------


def _stem() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)


def read_snapshots(
    spark: SparkSession, path: str | Sequence[str], symbol: str | None = None, symbols: Sequence[str] | None = None
) -> DataFrame:
    """Type-first ``.store`` files (one, many or a folder): snapshots with mid,
    spread and imbalance. The symbol is the file stem unless given."""
    raw = (
        spark.read.schema(schemas.SNAPSHOT)
        .option("comment", "#")
        .option("pathGlobFilter", "*.store")
        .csv(path)
        .select("*", (F.lit(symbol) if symbol else _stem()).alias("symbol"))
    )
    if symbols is not None:
        raw = raw.where(F.col("symbol").isin(list(symbols)))
    made = {"timestamp": epoch_to_ts("timestamp_ms"), **snapshot_features()}
    return raw.withColumns(made).select(
        "timestamp",
        "timestamp_ms",
        "symbol",
        "bid_price",
        "bid_qty",
        "ask_price",
        "ask_qty",
        "mid_price",
        "spread",
        "spread_bps",
        "book_imbalance",
        "volume",
    )


def read_book(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = schemas.BOOK,
    *,
    delimiter: str = ",",
    header: bool = False,
    skip_rows: int = 0,
    time_col: str = "ts_ms",
) -> DataFrame:
    """``.store`` files of a configured layout; rows with any NULL are dropped and ``ts`` is the
    UTC time. The first ``skip_rows`` lines of every file are left out, and then a ``header``."""
    leading = skip_rows + header
    if leading <= 1:
        reader = spark.read.schema(schema).option("sep", delimiter).option("header", leading > 0)
        rows = reader.csv(path)
    else:
        cells = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        row = F.from_csv("value", cells, {"sep": delimiter})
        rows = _lines_after(spark, path, leading).select(row.alias("row")).select("row.*")
    return rows.dropna().withColumn("ts", F.timestamp_millis(time_col))


# Files whose first lines are sent to every task.
MOST_FILES = 50_000


def _lines_after(spark: SparkSession, path: str | Sequence[str], leading: int) -> DataFrame:
    """The lines of text files without the first ``leading`` ones of each."""
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        "value",
        # Consecutive within a split of a file; only the split at 0 holds the first lines.
        F.monotonically_increasing_id().alias("n"),
    )
    firsts = lines.where("at = 0").groupBy("file").agg(F.min("n").alias("first"))
    firsts = F.broadcast(firsts) if firsts.count() <= MOST_FILES else firsts
    numbered = lines.join(firsts, "file", "left")
    return numbered.where((F.col("at") > 0) | (F.col("n") - F.col("first") >= leading)).select("value")


def read_streamer_snapshots(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Symbol-first ``.store`` lines ``symbol,timestamp,bid,bidq,ask,askq[,volume]``.
    Malformed lines are left out and a missing volume is 0."""
    return streamer_columns(spark.read.text(path))


def streamer_columns(lines: DataFrame, line: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    out = streamer_cells(lines, line, [*keep, "fields"]).where(F.col("fields") >= 6).drop("fields")
    return out.dropna(subset=["timestamp", "bid_price", "bid_qty", "ask_price", "ask_qty", "volume"])


def streamer_cells(lines: DataFrame, line: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The cells of symbol-first lines, NULL where one is missing or not a number. ``fields``
    may be kept as well: how many a line has."""
    part = F.split(F.col(line), ",")

    def num(i: int) -> Column:
        return F.trim(F.get(part, i)).try_cast("double")

    return lines.withColumn("fields", F.size(part)).select(
        *keep,
        F.get(part, 0).alias("symbol"),
        F.trim(F.get(part, 1)).try_cast("bigint").alias("timestamp"),
        num(2).alias("bid_price"),
        num(3).alias("bid_qty"),
        num(4).alias("ask_price"),
        num(5).alias("ask_qty"),
        F.when(F.size(part) > 6, num(6)).otherwise(0.0).alias("volume"),
    )


# -- messages and logs ---------------------------------------------------------------------


def read_messages(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = schemas.MESSAGES) -> DataFrame:
    """JSON message batches, one object or one array per file, gzip or plain."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def _log_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Headed CSV whose empty, ``null`` and ``NaN`` cells are NULL. Columns are found by name
    in each file's own header, so the files of a folder may order them differently, lack some
    or have others besides."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path if isinstance(path, str) else list(path))
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value"
    ).where(F.trim("value") != "")
    # Numbers ascend within a split of a file, and only the split at 0 holds the header.
    numbered = lines.withColumn("n", F.monotonically_increasing_id()).where("at = 0")
    headers = numbered.groupBy("file").agg(F.min_by("value", "n").alias("header"))
    width = headers.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1
    cells = ", ".join(f"_c{i} string" for i in range(width))

    def parsed(line: Column) -> Column:
        part = F.from_csv(line, cells)
        return F.array(*(part[f"_c{i}"] for i in range(width)))

    named = headers.select("file", "header", parsed(F.ltrim("header", F.lit("\ufeff"))).alias("names"))
    # A line like the header is the header, or has no time and no number in it.
    rows = lines.join(named, "file").where(F.col("value") != F.col("header"))
    rows = rows.select("names", parsed(F.col("value")).alias("cells"))
    picks = []
    for f in schema:
        cell = F.get("cells", F.array_position("names", f.name).cast("int") - 1)
        cell = F.when(~cell.isin("", "null", "NaN"), cell)
        picks.append(cell.try_cast(f.dataType).alias(f.name))
    return rows.select(*picks)


def _timed(df: DataFrame, symbols: Iterable[str] | None, name: str) -> DataFrame:
    out = df.withColumn(name, parse_ts("timestamp")).where(F.col(name).isNotNull())
    return out if symbols is None else out.where(F.col("symbol").isin(list(symbols)))


def read_strategy_updates(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Strategy updates with ``ts``; rows whose time does not parse are dropped."""
    return _timed(_log_csv(spark, path, schemas.STRATEGY_UPDATES), None, "ts")


def read_trade_fills(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Trade fills with ``ts``; rows whose time does not parse are dropped."""
    return _timed(_log_csv(spark, path, schemas.TRADE_FILLS), None, "ts")


def read_signals(spark: SparkSession, path: str | Sequence[str], symbols: Iterable[str] | None = None) -> DataFrame:
    return _timed(_log_csv(spark, path, schemas.SIGNALS), symbols, "timestamp")


def read_fills(spark: SparkSession, path: str | Sequence[str], symbols: Iterable[str] | None = None) -> DataFrame:
    return _timed(_log_csv(spark, path, schemas.FILLS), symbols, "timestamp")


# -- feature tables --------------------------------------------------------------------------


def read_features(
    spark: SparkSession,
    root: str,
    symbols: Sequence[str],
    start: dt.date | None = None,
    end: dt.date | None = None,
    days_back: int = 7,
    *,
    today: dt.date | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Feature parquet below ``root/symbol/date/hour/`` for an inclusive date range
    or the last ``days_back`` days. Only the folders of those dates are listed;
    unreadable files are skipped; ``file_ledger`` lists them. Without a schema it is taken from one file, which
    has to be readable."""
    end = end or today or dt.date.today()
    start = start or end - dt.timedelta(days=days_back)
    days = [(start + dt.timedelta(days=i)).isoformat() for i in range((end - start).days + 1)]
    glob = f"{root.rstrip('/')}/{{{','.join(symbols)}}}/{{{','.join(days)}}}/*/*.parquet"
    path = F.col("_metadata.file_path")
    reader = spark.read.option("ignoreCorruptFiles", "true")
    found = (reader.schema(schema) if schema else reader).parquet(glob)
    return found.drop("symbol", "date", "hour").select(
        "*",
        F.regexp_extract(path, r"/([^/]+)/\d{4}-\d{2}-\d{2}/[^/]+/[^/]+$", 1).alias("symbol"),
        F.regexp_extract(path, r"/(\d{4}-\d{2}-\d{2})/[^/]+/[^/]+$", 1).cast("date").alias("date"),
        F.regexp_extract(path, r"/\d{4}-\d{2}-\d{2}/([^/]+)/[^/]+$", 1).alias("hour"),
    )


def read_feature_table(
    spark: SparkSession,
    path: str,
    symbols: Sequence[str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """A feature table written ``symbol=/date=/hour=``; the filters prune partitions."""
    out = spark.read.option("ignoreCorruptFiles", "true").parquet(path)
    if symbols is not None:
        out = out.where(F.col("symbol").isin(list(symbols)))
    if start:
        out = out.where(F.col("date") >= F.lit(start))
    if end:
        out = out.where(F.col("date") <= F.lit(end))
    return out


def read_local_features(spark: SparkSession, root: str, symbols: Sequence[str]) -> DataFrame:
    """Every parquet file below ``root`` whose name holds a symbol."""
    out = None
    for s in symbols:
        part = (
            spark.read.option("recursiveFileLookup", "true")
            .option("ignoreCorruptFiles", "true")
            .option("pathGlobFilter", f"*{s}*.parquet")
            .parquet(root)
            .withColumn("symbol", F.lit(s))
        )
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no symbols given")
    return out


def file_ledger(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(file, bytes, rows, rows_read, status, error): what became of every Parquet file below a
    path, since the readers here pass over what they cannot read.

    ``rows`` is what the file's footer says, ``rows_read`` what could be decoded of all columns.
    ``status`` is ``read``, ``cut short`` where some rows are missing, or ``unread`` for a file
    that gave no footer, with the ``error``. Reads every column once; only files without a
    footer are then looked at one by one.
    """

    def option(reader):
        return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)

    file = F.col("_metadata.file_path").alias("file")
    listed = option(spark.read.format("binaryFile")).load(path).select(file, F.col("length").alias("bytes"))
    listed = stage(listed)
    schema = _first_schema(spark, listed)
    if schema is None:
        stated, decoded = (spark.createDataFrame([], f"file string, {c} long") for c in ("rows", "rows_read"))
    else:
        found = option(spark.read.schema(schema).option("ignoreCorruptFiles", "true")).parquet(path)
        stated = found.select(file).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
        # The hash makes Spark decode every column of the rows it counts; it is written with them.
        whole = found.select(file, F.xxhash64(*[F.col(f"`{c}`") for c in found.columns]).alias("h"))
        decoded = whole.groupBy("file").agg(F.count("h").alias("rows_read"), F.bit_xor("h").alias("h"))
    known = stage(listed.join(stated, "file", "left").join(decoded, "file", "left"))
    errors = []
    for row in known.where("rows IS NULL").select("file").toLocalIterator():
        try:
            spark.read.parquet(row["file"]).limit(1).collect()
        except Exception as why:  # whatever the file's fault is, it is reported
            errors.append((row["file"], " ".join(str(why).split())[:500]))
    failed = spark.createDataFrame(errors, "file string, error string")
    rows, read = (F.coalesce(c, F.lit(0).cast("bigint")) for c in ("rows", "rows_read"))
    status = F.when(F.col("error").isNotNull(), "unread").when(read < rows, "cut short").otherwise("read")
    out = known.join(failed, "file", "left")
    return out.select("file", "bytes", rows.alias("rows"), read.alias("rows_read"), status.alias("status"), "error")


def _first_schema(spark: SparkSession, listed: DataFrame) -> T.StructType | None:
    """The schema of the first file that tells one."""
    for row in listed.select("file").toLocalIterator():
        try:
            return spark.read.parquet(row["file"]).schema
        except Exception:  # reported by the ledger
            continue
    return None


def read_split(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """One split of a dataset written by ``write_splits``."""
    return spark.read.parquet(path).where(F.col("split") == split)


def read_table(spark: SparkSession, path: str, time_col: str = "ts_ms") -> DataFrame:
    """A parquet or CSV table with an epoch-millisecond column; every other column
    has to be numeric. A cell that is not raises when it is read."""
    if path.rstrip("/").endswith(".csv"):
        df = spark.read.option("header", True).csv(path)
    elif path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported file type: {path}")
    if time_col not in df.columns:
        raise ValueError(f"column {time_col} not found")
    picks = [F.col(time_col).cast("bigint").alias(time_col)]
    for f in df.schema:
        if f.name == time_col:
            continue
        keep = isinstance(f.dataType, T.NumericType)
        picks.append(F.col(f.name) if keep else F.col(f.name).cast("double").alias(f.name))
    return df.select(*picks).withColumn("ts", F.timestamp_millis(time_col))
