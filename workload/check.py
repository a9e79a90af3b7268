"""Compare queries with their SQL on DuckDB:
``python -m workload.check [sf] [--chunk N] [name..]``. A small chunk size makes every
ordered operator cut its series into ranges."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(x):
    if isinstance(x, float):
        return None if math.isnan(x) else x
    if isinstance(x, (list, tuple)):
        return tuple(_cell(e) for e in x)
    return x


def _sorted(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, nothing when equal."""
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(set(names) ^ set(df.columns))}"]
    want = _sorted(names, theirs.fetchall())
    got = _sorted(df.columns, df.collect())
    if len(want) != len(got):
        return [f"rows: {len(got)} instead of {len(want)}"]
    return [f"{g}\n  instead of {w}" for g, w in zip(got, want) if g != w]


def main() -> None:
    from tickspark.session import CHUNK_ROWS, get_session
    from workload import ORACLE, QUERIES

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0][0].isdigit() else "0.01"
    chunk = {}
    if args[:1] == ["--chunk"]:
        chunk[CHUNK_ROWS] = args[1]
        args = args[2:]
    names = args or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session(
        "check",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for key, value in chunk.items():
        spark.conf.set(key, value)
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                diff = differences(df, con, ORACLE[name])
            else:
                diff = [] if df.count() else ["no rows"]
        except Exception as e:
            diff = [f"{type(e).__name__}: {str(e)[:1500]}"]
        kind = "" if name in ORACLE else " (rows only)"
        print(f"{'ok  ' if not diff else 'FAIL'} {name}{kind} {time.time() - start:.2f}s", flush=True)
        if diff:
            bad += 1
            print(f"  {len(diff)} differ; first: {diff[0]}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
