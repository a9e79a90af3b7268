"""Headline queries, one warm-up and the median of three runs each, results forced
with the noop sink. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from tickspark.operators.bars import flow_bars
from tickspark.plans.datasets import trade_features
from tickspark.operators.windows import rolling_flow
from tickspark.session import get_session
from workload import QUERIES
from workload.views import LINE_ORDER, Views

RUNS = 3


def roll_lines(spark, sf_dir):
    lines = Views(spark, sf_dir).lines
    return rolling_flow(flow_bars(lines, "1d", order=LINE_ORDER), advanced=True, trades=lines)


def features_lines(spark, sf_dir):
    return trade_features(Views(spark, sf_dir).lines, "1d", order=LINE_ORDER, advanced=True)


HEADLINE = {
    "bars_flow_lines": QUERIES["bars_flow_lines"],
    "roll_lines": roll_lines,
    "asof_chain": QUERIES["asof_chain"],
    "split_segment": QUERIES["split_segment"],
    "features_lines": features_lines,
    "tick_features": QUERIES["tick_features"],
    "asof_backward": QUERIES["asof_backward"],
    "spearman": QUERIES["spearman"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, query in HEADLINE.items():
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
