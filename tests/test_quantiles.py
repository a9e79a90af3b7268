"""Radix selection against sorting, whatever the number of passes; average ranks."""

import math
import random

import pytest

from tickspark.operators import quantiles
from tickspark.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.3, 0.5, 0.75, 0.99, 1.0]
INF = math.inf


def brute(values, probs):
    xs = sorted(x for x in values if x is not None and not math.isnan(x))
    out = []
    for p in probs:
        if not xs:
            out.append(None)
            continue
        at = p * (len(xs) - 1)
        lo, hi, part = xs[math.floor(at)], xs[math.ceil(at)], at - math.floor(at)
        out.append(lo if lo == hi or part == 0 else lo * (1 - part) + hi * part)
    return out


def same(got, want):
    return all(g == w or (g is not None and w is not None and math.isnan(g) and math.isnan(w)) for g, w in zip(got, want))


COLUMNS = {
    "plain": [random.Random(1).gauss(0, 1) for _ in range(500)],
    "ties": [float(random.Random(i).randint(-2, 2)) for i in range(500)],
    "close": [1.0 + i * 2.0**-52 for i in range(500)],
    "wide": [(-1) ** i * 10.0 ** (i % 600 - 300) for i in range(500)],
    "odd": ([None, math.nan, INF, -INF, 0.0, -0.0, 5e-324, -5e-324, 1.0, 3.0] * 50),
    "empty": [None, math.nan] * 250,
    "infinite": [INF, -INF] * 250,
}


@pytest.mark.parametrize("few", [quantiles.FEW, 0])
def test_agrees_with_sorting(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW", few)
    rows = list(zip(*COLUMNS.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in COLUMNS)).repartition(4)
    got = exact_quantiles(df, list(COLUMNS), PROBS)
    for name, values in COLUMNS.items():
        assert same(got[name], brute(values, PROBS)), name


@pytest.mark.parametrize("few", [quantiles.FEW, 0])
@pytest.mark.parametrize("values", [[-INF, 1.0, 3.0], [1.0, 3.0, INF], [7.0], [None, None], []])
def test_small_tables(spark, monkeypatch, few, values):
    monkeypatch.setattr(quantiles, "FEW", few)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert same(exact_quantiles(df, ["x"], [0.25, 0.5])["x"], brute(values, [0.25, 0.5]))


def test_other_types_and_bad_probabilities(spark):
    df = spark.createDataFrame([(k, k % 3 == 0) for k in range(10)], "n int, flag boolean")
    assert exact_quantiles(df, ["n", "flag"], [0.5]) == {"n": [4.5], "flag": [0.0]}
    with pytest.raises(ValueError):
        exact_quantiles(df, ["n"], [1.5])


def test_agrees_with_the_built_in(spark):
    from pyspark.sql import functions as F

    df = spark.range(20000).selectExpr("(id * 7919 % 10007) / 3.0 - 1000 AS x")
    want = df.agg(F.percentile("x", PROBS)).first()[0]
    assert exact_quantiles(df, ["x"], PROBS)["x"] == pytest.approx(want)


def brute_ranks(values):
    order = sorted(values)
    return [(2 * order.index(v) + order.count(v) + 1) / 2 for v in values]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_average_ranks_across_ranges(spark, parts):
    """One value fills most of a column, so its run goes over several ranges."""
    from pyspark.sql import functions as F

    from tickspark.operators.explore import average_ranks

    hot = [5.0] * 150 + [float(i % 7) for i in range(60)]
    rare = [random.Random(i).random() for i in range(210)]
    same_ = [1.0] * 210
    rows = list(zip(range(210), hot, rare, same_, [INF if i % 3 else -INF for i in range(210)]))
    names = ["hot", "rare", "same", "far"]
    df = spark.createDataFrame(rows, "row long, hot double, rare double, same double, far double").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        made = average_ranks(df, "row", names)
        got = {(r["column"], r["row"]): r["rank"] for r in made.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for at, name in enumerate(names, 1):
        want = brute_ranks([r[at] for r in rows])
        assert [got[name, k] for k in range(210)] == want, name
    assert made.select(F.count("rank")).first()[0] == 840


def test_tasks_of_ranks_follow_the_number_of_values(spark, monkeypatch):
    """However large the table, a task sorts, numbers and brings together about RANKED values."""
    from tickspark.operators import explore

    staged, dealt, stage, pearson = [], [], explore.stage, explore.pearson
    monkeypatch.setattr(explore, "RANKED", 100, raising=False)
    monkeypatch.setattr(explore, "stage", lambda df: staged.append(stage(df)) or staged[-1])
    monkeypatch.setattr(explore, "pearson", lambda df, *args: dealt.append(df) or pearson(df, *args))
    rows = [(5.0 if i % 4 else float(i % 7), random.Random(i).random()) for i in range(1000)] + [(None, 1.0)]
    got = explore.spearman(spark.createDataFrame(rows, "hot double, rare double").repartition(3), ["hot", "rare"])
    ranks = [brute_ranks([r[i] for r in rows[:-1]]) for i in (0, 1)]
    mean = [sum(x) / 1000 for x in ranks]
    moment = {(i, j): sum((a - mean[i]) * (b - mean[j]) for a, b in zip(ranks[i], ranks[j])) for i in (0, 1) for j in (0, 1)}
    want = moment[0, 1] / (moment[0, 0] * moment[1, 1]) ** 0.5
    assert [r["corr"] for r in got.collect()] == pytest.approx([1.0, want, 1.0])
    sizes = [r["count"] for r in staged[1].groupBy("part").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 250
    assert dealt[0].rdd.getNumPartitions() == 20


def test_a_run_is_written_in_batches_of_the_sizes_read(spark, monkeypatch):
    """A value that fills a range does not come out as one batch."""
    import pyarrow as pa
    import pyspark

    from tickspark.operators.explore import _runs

    class Context:
        get = staticmethod(lambda: Context)
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(pyspark, "TaskContext", Context)
    parts = [pa.record_batch({"column": ["x"] * 10, "row": list(range(k, k + 10)), "value": [1.0] * 10}) for k in range(0, 500, 10)]
    parts.append(pa.record_batch({"column": ["x", "y"], "row": [500, 0], "value": [2.0, 2.0]}))
    out = list(_runs()(iter(parts)))
    assert max(b.num_rows for b in out) <= 10
    rows = [(r["column"], r["row"], r["first"], r["last"]) for b in out for r in b.to_pylist()]
    assert rows == [("x", i, 0, 499) for i in range(500)] + [("x", 500, 500, 500), ("y", 0, 0, 0)]


@pytest.mark.parametrize("parts", [1, 5])
def test_steps_between_times_of_many_ranges(spark, parts):
    from collections import Counter

    from tickspark.operators.quality import QualityRules, quality_report, step_counts

    times = [7] * 60 + [3 * i for i in range(40)] + [1000, 5, -4] + [2**40]
    df = spark.createDataFrame([(t, 1.0) for t in times] + [(None, 1.0)] * 2, "ts_ms long, x double").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["dt"]: r["n"] for r in step_counts(df, "ts_ms").collect()}
        row = quality_report(df, QualityRules(expected_dt=3), strict=False).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    times.sort()
    steps = sorted(b - a for a, b in zip(times, times[1:]))
    assert got == Counter(steps)
    assert (row["ts_duplicates"], row["dt_min"], row["dt_max"]) == (steps.count(0) + 1, 0, steps[-1])
    assert row["dt_median"] == brute(map(float, steps), [0.5])[0]
    assert row["pct_dt_expected"] == pytest.approx(100 * steps.count(3) / len(steps))
    empty = quality_report(df.limit(0), strict=False).first()
    assert (empty["rows"], empty["dt_median"], empty["ts_duplicates"]) == (0, None, 0)


def test_weighted_quantiles(spark):
    rows = [(3.0, 2), (1.0, 5), (9.0, 0), (None, 4), (2.0, 1)]
    df = spark.createDataFrame(rows, "x double, n long")
    want = brute([1.0] * 5 + [2.0] + [3.0] * 2, PROBS)
    assert exact_quantiles(df, ["x"], PROBS, weight="n")["x"] == want
