"""Queries and the SQL each one is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.views import SHIFT, SQL, Views, tidy

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, tidied: bool = True):
    """Register a function of ``Views`` under its own name. The SQL may use the view
    names and the shared tables of ``SHARED``; ``R(expr)`` rounds a double."""

    def register(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(Views(spark, sf_dir))
            return tidy(out) if tidied else out

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = _expand(sql)
        return fn

    return register


# Shared steps of the SQL side: name -> (statement).
SHARED: dict[str, str] = {}


def _expand(sql: str) -> str:
    known = {**SQL, **SHARED}
    needed: list[str] = []

    def add(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                add(known[name])
                if name not in needed:
                    needed.append(name)

    add(sql)
    ctes = ", ".join(f"{n} AS ({known[n]})" for n in needed)
    body = sql.strip()
    if ctes:
        body = f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"
    return _rounded(body)


def _rounded(sql: str) -> str:
    """``R(x)`` -> x to 6 places as ``views.rounded`` does it, keeping nested brackets."""
    out = ""
    while (m := re.search(r"\bR\(", sql)) is not None:
        out += sql[: m.start()]
        depth, i = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            i += 1
        scaled = f"CAST({sql[m.end() : i - 1]} AS DOUBLE) * 1e6::DOUBLE + {SHIFT}::DOUBLE"
        out += f"(round_even({scaled}, 0) / 1e6::DOUBLE + 0.0::DOUBLE)"
        sql = sql[i:]
    return out + sql
