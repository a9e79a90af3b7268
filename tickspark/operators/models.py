"""Baseline models on MLlib: fit, score, importances; models of every symbol."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions.expr import finite_or_zero
from tickspark.operators.metrics import evaluate_classifier, evaluate_groups, regression_metrics
from tickspark.session import stage

# Default hyper-parameters per model kind.
DEFAULTS = {
    "logistic": {"C": 1.0, "max_iter": 1000},
    "ridge": {"alpha": 1.0},
    "random_forest": {"trees": 100, "max_depth": 10},
    "gbt": {"trees": 100, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8},
}
CLASSIFIERS = ("logistic", "random_forest", "gbt")


@dataclass(frozen=True)
class Fitted:
    """A trained model with its features and class values (index = model class)."""

    kind: str
    model: Model
    features: tuple[str, ...]
    classes: tuple[float, ...] = ()
    label: str = "label"
    details: dict = field(default_factory=dict)

    @property
    def is_classifier(self) -> bool:
        return bool(self.classes)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` and, for a classifier, one probability column
        ``p_0..p_k`` per class. Two classes are cut at probability > 0.5, more take
        the likeliest."""
        vec = _assemble(df, self.features).drop("probability", "rawPrediction", "prediction")
        out = self.model.transform(vec).drop("__features", "rawPrediction")
        if not self.is_classifier:
            return out
        probs = vector_to_array("probability")
        out = out.withColumns({f"p_{i}": probs[i] for i in range(len(self.classes))})
        values = F.array(*[F.lit(float(c)) for c in self.classes])
        if len(self.classes) == 2:
            index = (F.col("p_1") > 0.5).cast("int")
        else:
            index = F.col("prediction").cast("int")
        return out.withColumn("prediction", F.get(values, index)).drop("probability")

    @property
    def scores(self) -> dict[float, str]:
        return {c: f"p_{i}" for i, c in enumerate(self.classes)}

    def evaluate(self, df: DataFrame) -> DataFrame:
        scored = self.score(df)
        if self.is_classifier:
            return evaluate_classifier(scored, self.label, "prediction", self.scores)
        return regression_metrics(scored, self.label, "prediction")

    def importance(self, spark: SparkSession, top: int | None = None) -> DataFrame:
        """(feature, importance), largest first: mean |coefficient| over the classes
        of a linear model, or the tree importance."""
        if self.kind == "logistic":
            rows = self.model.coefficientMatrix.toArray()
            values = abs(rows).mean(axis=0)
        elif self.kind == "ridge":
            values = abs(self.model.coefficients.toArray())
        else:
            values = self.model.featureImportances.toArray()
        table = spark.createDataFrame(
            [(f, float(v)) for f, v in zip(self.features, values)], "feature string, importance double"
        )
        table = table.orderBy(F.col("importance").desc(), "feature")
        return table.limit(top) if top else table


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    safe = {f"__v{i}": finite_or_zero(F.col(f).cast("double")) for i, f in enumerate(features)}
    out = VectorAssembler(inputCols=list(safe), outputCol="__features").transform(df.withColumns(safe))
    return out.drop(*safe)


def fit(
    train: DataFrame,
    features: Sequence[str],
    label: str = "label",
    kind: str = "logistic",
    *,
    validation: DataFrame | None = None,
    seed: int = 42,
    **params: float,
) -> Fitted:
    """Train a baseline.

    logistic      -- binary or multinomial, classes weighted inversely to their size
    ridge         -- linear regression with squared penalty
    random_forest -- classifier or, with ``regression=1``, regressor
    gbt           -- boosted trees, binary or, with ``regression=1``, regressor; a
                     validation frame stops the boosting early
    """
    if kind not in DEFAULTS:
        raise ValueError(f"unknown model: {kind}")
    opt = {**DEFAULTS[kind], **params}
    features = tuple(features)
    known = train.where(F.col(label).isNotNull())
    regression = kind == "ridge" or bool(opt.pop("regression", 0))
    data = _assemble(known.select(*dict.fromkeys([*features, label])), features)
    if regression:
        data = data.select("__features", F.col(label).cast("double").alias("__y"))
        return Fitted(kind, _regressor(kind, opt, data, seed), features, (), label)

    # One row per class.
    sizes = {float(r[0]): r["count"] for r in known.groupBy(F.col(label).cast("double")).count().collect()}
    classes = tuple(sorted(sizes))
    if len(classes) < 2:
        raise ValueError(f"training labels hold one class: {classes}")
    n = sum(sizes.values())
    index = F.lit(None).cast("double")
    weight = F.lit(1.0)
    for i, c in enumerate(classes):
        index = F.when(F.col(label).cast("double") == c, float(i)).otherwise(index)
        weight = F.when(F.col(label).cast("double") == c, n / (len(classes) * sizes[c])).otherwise(weight)
    columns = ["__features", index.alias("__y"), weight.alias("__w")]
    data = data.select(*columns)
    common = {"featuresCol": "__features", "labelCol": "__y"}
    if kind == "logistic":
        est = LogisticRegression(
            **common,
            weightCol="__w",
            maxIter=int(opt["max_iter"]),
            regParam=1.0 / (n * opt["C"]),
            standardization=False,
            family="binomial" if len(classes) == 2 else "multinomial",
        )
    elif kind == "random_forest":
        est = RandomForestClassifier(**common, numTrees=int(opt["trees"]), maxDepth=int(opt["max_depth"]), seed=seed)
    else:
        if len(classes) > 2:
            raise ValueError("gbt separates two classes; use random_forest or logistic for more")
        if validation is not None:
            held = _assemble(validation.where(F.col(label).isNotNull()), features).select(*columns)
            data = data.withColumn("__held", F.lit(False)).unionByName(held.withColumn("__held", F.lit(True)))
            common["validationIndicatorCol"] = "__held"
        est = GBTClassifier(
            **common,
            maxIter=int(opt["trees"]),
            maxDepth=int(opt["max_depth"]),
            stepSize=float(opt["learning_rate"]),
            subsamplingRate=float(opt["subsample"]),
            seed=seed,
        )
    return Fitted(kind, est.fit(data), features, classes, label)


def _regressor(kind: str, opt: dict, data: DataFrame, seed: int) -> Model:
    common = {"featuresCol": "__features", "labelCol": "__y"}
    if kind == "ridge":
        n, spread = data.agg(F.count(F.lit(1)), F.stddev_pop("__y")).first()
        # The library divides the penalty by the label's deviation; here it is alpha's alone.
        est = LinearRegression(
            **common, elasticNetParam=0.0, regParam=float(opt["alpha"]) / max(n, 1) * (spread or 1.0), standardization=False
        )
    elif kind == "random_forest":
        est = RandomForestRegressor(**common, numTrees=int(opt["trees"]), maxDepth=int(opt["max_depth"]), seed=seed)
    elif kind == "gbt":
        est = GBTRegressor(
            **common,
            maxIter=int(opt["trees"]),
            maxDepth=int(opt["max_depth"]),
            stepSize=float(opt["learning_rate"]),
            subsamplingRate=float(opt["subsample"]),
            seed=seed,
        )
    else:
        raise ValueError(f"no regressor: {kind}")
    return est.fit(data)


# -- one model for each symbol --------------------------------------------------------------


@dataclass(frozen=True)
class SymbolModels:
    """Linear models of many symbols. ``table``: (symbol, classes, weights): a row of weights
    per class, or one for two classes and for ridge, the intercept last."""

    kind: str
    features: tuple[str, ...]
    table: DataFrame
    symbol: str = "symbol"

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` and, for classifiers, ``classes`` and their probabilities
        ``scores``. Rows of a symbol without a model have none."""
        known = self.table.withColumnRenamed(self.symbol, "__symbol")
        own = df.join(known, F.col(self.symbol).eqNullSafe(F.col("__symbol")), "left").drop("__symbol")
        x = F.array(*[finite_or_zero(F.col(f).cast("double")) for f in self.features], F.lit(1.0))
        sums = F.transform(
            "weights", lambda w: F.aggregate(F.zip_with(w, x, lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
        )
        own = own.withColumn("__z", sums)
        if self.kind == "ridge":
            return own.withColumn("prediction", F.get("__z", F.lit(0))).drop("__z", "weights", "classes")
        one = 1 / (1 + F.exp(-F.get("__z", F.lit(0))))
        powers = F.transform("__z", lambda z: F.exp(z - F.array_max("__z")))
        total = F.aggregate(powers, F.lit(0.0), lambda t, v: t + v)
        several = F.transform(powers, lambda p: p / total)
        scores = F.when(F.size("__z") == 1, F.array(1 - one, one)).otherwise(several)
        own = own.withColumn("scores", F.when(F.col("__z").isNotNull(), scores))
        best = F.array_position("scores", F.array_max("scores")).cast("int") - 1
        index = F.when(F.size("__z") == 1, (F.get("scores", F.lit(1)) > 0.5).cast("int")).otherwise(best)
        return own.withColumn("prediction", F.get("classes", index)).drop("__z", "weights")


STEPS, CLOSE = 100, 1e-9


def fit_symbols(
    train: DataFrame, features: Sequence[str], label: str = "label", kind: str = "logistic", *, symbol: str = "symbol", **params: float
) -> SymbolModels:
    """Logistic or ridge models of all symbols together, by Newton's method: each step is one
    job that adds up gradient and curvature by symbol, however many symbols there are. A step
    that makes a symbol's fit worse is halved. Weights agree with those of ``fit`` for the
    symbol alone. A symbol whose training rows hold one class has no model.

    What comes to the driver is one row of weights per symbol and class; the sums of a symbol
    with a third of the rows are made by many tasks."""
    import numpy as np

    if kind not in ("logistic", "ridge"):
        raise ValueError(f"no joint fit: {kind}")
    opt = {**DEFAULTS[kind], **params}
    features = tuple(features)
    spark, width = train.sparkSession, len(features) + 1
    known = train.where(F.col(label).isNotNull())
    rows = known.select(
        F.col(symbol).cast("string").alias("symbol"),
        F.col(label).cast("double").alias("y"),
        F.array(*[finite_or_zero(F.col(f).cast("double")) for f in features], F.lit(1.0)).alias("x"),
    )
    rows = stage(rows)
    ridge = kind == "ridge"
    group = rows.groupBy("symbol") if ridge else rows.groupBy("symbol", "y")
    sizes: dict = {}
    for r in group.count().collect():  # one row per symbol and class
        sizes.setdefault(r["symbol"], {})[0.0 if ridge else r["y"]] = r["count"]
    state = {}
    for name, counts in sizes.items():
        if ridge or len(counts) > 1:
            n = sum(counts.values())
            classes = [] if ridge else sorted(counts)
            each = [n / (len(classes) * counts[c]) for c in classes]
            shape = (1 if len(classes) <= 2 else len(classes), width)
            penalty = float(opt["alpha"]) / n if ridge else 1.0 / (n * float(opt["C"]))
            state[name] = {"n": n, "classes": classes, "each": each, "w": np.zeros(shape), "penalty": penalty}
    waiting = set(state)
    for _ in range(int(opt.get("max_iter", STEPS))):
        if not waiting:
            break
        shared = spark.sparkContext.broadcast({name: state[name] for name in waiting})  # weights only
        sums = rows.mapInArrow(_newton_sums(shared, ridge), "symbol string, sums array<double>")
        found = sums.groupBy("symbol").applyInArrow(_newton_step(shared), "symbol string, fit double, slope double, step array<double>")
        for r in found.collect():
            own = state[r["symbol"]]
            step = np.array(r["step"]).reshape(own["w"].shape)
            if r["fit"] > own.get("fit", np.inf) + 1e-15:
                own["last"] = own["last"] / 2
                own["w"] = own["w"] - own["last"]
            elif r["slope"] <= CLOSE or not np.isfinite(step).all():
                waiting.discard(r["symbol"])
            else:
                own["fit"], own["last"] = r["fit"], step
                own["w"] = own["w"] + step
        shared.unpersist()
    table = [(name, own["classes"], own["w"].tolist()) for name, own in state.items()]
    schema = f"`{symbol}` string, classes array<double>, weights array<array<double>>"
    return SymbolModels(kind, features, spark.createDataFrame(table, schema), symbol)


def _newton_sums(shared, ridge: bool):
    """Function over (symbol, y, x): loss, gradient and curvature of a task's rows by symbol."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        models, totals = shared.value, {}
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            codes = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            ys = batch.column(1).to_numpy(zero_copy_only=False)
            xs = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(ys), -1)
            for code in np.unique(codes):
                name = None if code < 0 else names.dictionary[int(code)].as_py()
                if name not in models:
                    continue
                own, here = models[name], codes == code
                x, y, w = xs[here], ys[here], own["w"]
                z = x @ w.T
                if ridge:
                    gap = z[:, 0] - y
                    loss, slope, bend = (gap @ gap) / 2, (x.T @ gap)[None], (x.T @ x)[None, None]
                else:
                    index = np.searchsorted(own["classes"], y)
                    weight = np.array(own["each"])[index]
                    if len(w) == 1:
                        sign = np.where(index == 1, 1.0, -1.0)
                        loss = weight @ np.logaddexp(0, -sign * z[:, 0])
                        p = 1 / (1 + np.exp(-np.clip(z[:, 0], -700, 700)))
                        slope = (x.T @ (weight * (p - index)))[None]
                        bend = (x.T @ (x * (weight * p * (1 - p))[:, None]))[None, None]
                    else:
                        top = z.max(axis=1, keepdims=True)
                        p = np.exp(z - top)
                        total = p.sum(axis=1, keepdims=True)
                        p /= total
                        loss = weight @ (np.log(total[:, 0]) + top[:, 0] - z[np.arange(len(y)), index])
                        hit = p.copy()
                        hit[np.arange(len(y)), index] -= 1
                        slope = (hit * weight[:, None]).T @ x
                        k = len(w)
                        bend = np.empty((k, k, x.shape[1], x.shape[1]))
                        for a in range(k):
                            for b in range(k):
                                part = weight * p[:, a] * ((a == b) - p[:, b])
                                bend[a, b] = x.T @ (x * part[:, None])
                flat = np.concatenate([[loss], slope.ravel(), bend.ravel()])
                totals[name] = totals[name] + flat if name in totals else flat
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.string()), pa.array([t.tolist() for t in totals.values()], pa.list_(pa.float64()))],
                names=["symbol", "sums"],
            )

    return run


def _newton_step(shared):
    """Function over the sums of a symbol, one row per task: the fit and the next step."""

    def run(key, table):
        import numpy as np
        import pyarrow as pa

        own = shared.value[key[0].as_py()]
        w, n = own["w"], own["n"]
        k, d = w.shape
        total = np.sum([np.array(s) for s in table.column("sums").to_pylist()], axis=0)
        held = np.ones((k, d)) * own["penalty"]
        held[:, -1] = 0  # the intercept is free
        fit = total[0] / n + (held * w * w).sum() / 2
        slope = total[1 : 1 + k * d] / n + (held * w).ravel()
        bend = total[1 + k * d :].reshape(k, k, d, d).transpose(0, 2, 1, 3).reshape(k * d, k * d) / n + np.diag(held.ravel())
        step = -np.linalg.lstsq(bend, slope, rcond=None)[0]
        return pa.table(
            {
                "symbol": pa.array([key[0].as_py()], pa.string()),
                "fit": pa.array([float(fit)]),
                "slope": pa.array([float(np.abs(slope).max())]),
                "step": pa.array([step.tolist()], pa.list_(pa.float64())),
            }
        )

    return run


def per_symbol(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    kind: str = "logistic",
    *,
    symbols: Sequence[str] | None = None,
    split: str = "split",
    symbol: str = "symbol",
    **params: float,
) -> DataFrame:
    """Train and evaluate a model for each named symbol, for all of the table if none are named:
    a row of validation metrics each. Logistic and ridge models are fitted all together, trees
    one symbol after the other. A symbol whose training rows hold one class is reported with
    NULL metrics."""
    spark = df.sparkSession
    if symbols is not None and not symbols:
        raise ValueError("no symbols given")
    if kind in ("logistic", "ridge"):
        own = df if symbols is None else df.where(F.col(symbol).isin(list(symbols)))
        own = stage(own.select(*dict.fromkeys([symbol, split, label, *features])))
        made = fit_symbols(own.where(F.col(split) == "train"), features, label, kind, symbol=symbol, **params)
        scored = made.score(own.where(F.col(split) == "val"))
        scored = stage(scored.where(F.col("prediction").isNotNull()))
        if kind == "ridge":
            metrics = regression_metrics(scored, label, "prediction", [symbol])
        else:
            metrics = evaluate_groups(scored, symbol, label, "prediction", "classes", "scores")
        names = own.select(F.col(symbol).alias("__symbol")).distinct()
        out = names.join(metrics, F.col(symbol).eqNullSafe(F.col("__symbol")), "left").drop(symbol)
        return out.withColumnRenamed("__symbol", symbol).select(symbol, *[c for c in metrics.columns if c != symbol])
    rows = None
    if symbols is None:
        symbols = [r[0] for r in df.select(symbol).distinct().orderBy(symbol).collect()]
    for s in symbols:
        own = df.where(F.col(symbol).eqNullSafe(s))
        try:
            model = fit(own.where(F.col(split) == "train"), features, label, kind, **params)
        except ValueError:
            line = spark.createDataFrame([(s,)], f"{symbol} string")
        else:
            line = model.evaluate(own.where(F.col(split) == "val")).select(F.lit(s).cast("string").alias(symbol), "*")
        rows = line if rows is None else rows.unionByName(line, allowMissingColumns=True)
    if rows is None:
        raise ValueError("no symbols given")
    return rows
