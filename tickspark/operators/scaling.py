"""Feature scaling. Parameters are fitted on the training rows by one aggregation
(a handful of numbers per feature) and applied anywhere as a projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.operators.quantiles import exact_quantiles

METHODS = ("standard", "robust", "minmax", "scale_only", "none")


@dataclass(frozen=True)
class Scaler:
    """x -> (x - centre) / scale per feature, in the order fitted."""

    method: str
    features: tuple[str, ...]
    centre: tuple[float, ...]
    scale: tuple[float, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        made = {
            f: (F.col(f) - F.lit(c)) / F.lit(s) for f, c, s in zip(self.features, self.centre, self.scale)
        }
        return df.withColumns(made)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (self.method, i, f, c, s) for i, (f, c, s) in enumerate(zip(self.features, self.centre, self.scale))
        ]
        return spark.createDataFrame(
            rows, "method string, position int, feature string, centre double, scale double"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Scaler:
        schema = "method string, position int, feature string, centre double, scale double"
        rows = spark.read.schema(schema).json(path).orderBy("position").collect()
        return Scaler(
            rows[0]["method"],
            tuple(r["feature"] for r in rows),
            tuple(r["centre"] for r in rows),
            tuple(r["scale"] for r in rows),
        )


def _scale(value: float | None) -> float:
    """A constant feature is divided by 1."""
    return 1.0 if not value else float(value)


def fit_scaler(train: DataFrame, features: Sequence[str], method: str = "standard") -> Scaler:
    """standard    -- mean and population deviation
    robust      -- median and inter-quartile range
    minmax      -- minimum and range
    scale_only  -- population deviation, no centring"""
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    features = tuple(features)
    zeros, ones = (0.0,) * len(features), (1.0,) * len(features)
    if method == "none" or not features:
        return Scaler(method, features, zeros, ones)
    if method == "robust":
        q = exact_quantiles(train, features, [0.25, 0.5, 0.75])
        centre = tuple(float(q[f][1] or 0.0) for f in features)
        scale = tuple(_scale((q[f][2] or 0.0) - (q[f][0] or 0.0)) for f in features)
        return Scaler(method, features, centre, scale)
    aggs = []
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        if method == "minmax":
            aggs += [F.min(x).alias(f"a{i}"), (F.max(x) - F.min(x)).alias(f"b{i}")]
        else:
            spread = F.when(F.min(x) == F.max(x), F.lit(0.0)).otherwise(F.stddev_pop(x))
            aggs += [F.avg(x).alias(f"a{i}"), spread.alias(f"b{i}")]
    row = train.agg(*aggs).first()
    centre = zeros if method == "scale_only" else tuple(float(row[f"a{i}"] or 0.0) for i in range(len(features)))
    return Scaler(method, features, centre, tuple(_scale(row[f"b{i}"]) for i in range(len(features))))


def fit_transform(
    df: DataFrame, features: Sequence[str], method: str = "standard", *, split: str = "split"
) -> tuple[DataFrame, Scaler]:
    """Fit on the rows marked train, apply to all."""
    scaler = fit_scaler(df.where(F.col(split) == "train"), features, method)
    return scaler.transform(df), scaler
