"""Metrics of scored tables, as aggregations. Only the confusion matrix, whose size
is the number of classes squared, and single totals are small; the rank statistics
run over distinct scores through ``Ordered``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.functions.expr import div
from tickspark.operators.ordered import Ordered

LOG_LOSS_EPS = 2.220446049250313e-16


def classification_metrics(
    df: DataFrame, truth: str = "label", pred: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """One row, or one for each group: accuracy and support-weighted precision, recall and F1.
    A class never predicted has precision 0."""
    cells = (
        df.where(F.col(truth).isNotNull() & F.col(pred).isNotNull())
        .groupBy(*by, F.col(truth).cast("double").alias("t"), F.col(pred).cast("double").alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_class = cells.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("t").alias("c"), F.col("n").alias("real"), F.lit(0).cast("bigint").alias("said")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("real"), F.col("n").alias("said")),
            )
        ).alias("s"),
        (F.col("t") == F.col("p")).alias("same"),
    ).select(*by, "s.*", F.when(F.col("same") & (F.col("s.real") > 0), F.col("s.real")).otherwise(0).alias("hit"))
    per = by_class.groupBy(*by, "c").agg(
        F.sum("real").alias("real"), F.sum("said").alias("said"), F.sum("hit").alias("hit")
    )
    precision = F.coalesce(div("hit", "said"), F.lit(0.0))
    recall = F.coalesce(div("hit", "real"), F.lit(0.0))
    f1 = F.coalesce(div(2 * F.col("hit"), F.col("said") + F.col("real")), F.lit(0.0))
    total, weight = F.sum("real"), F.col("real")
    return per.groupBy(*by).agg(
        total.alias("n"),
        div(F.sum("hit"), total).alias("accuracy"),
        div(F.sum(precision * weight), total).alias("precision"),
        div(F.sum(recall * weight), total).alias("recall"),
        div(F.sum(f1 * weight), total).alias("f1"),
    )


def auc(df: DataFrame, positive: Column, score: str) -> DataFrame:
    """One row ``auc``: probability that a positive scores above a negative, ties
    half. NULL when a class is missing."""
    return _auc(df.select(F.lit(0).alias("__class"), positive.cast("int").alias("__pos"), F.col(score).alias("__s"))).select(
        "auc"
    )


def auc_ovr(df: DataFrame, truth: str, scores: Mapping[float, str]) -> DataFrame:
    """One row ``auc``: mean of the one-versus-rest AUCs over the classes."""
    one = [
        F.struct(
            F.lit(i).alias("__class"), (F.col(truth) == F.lit(c)).cast("int").alias("__pos"), F.col(s).alias("__s")
        )
        for i, (c, s) in enumerate(scores.items())
    ]
    return _auc(df.select(F.explode(F.array(*one)).alias("x")).select("x.*")).agg(F.avg("auc").alias("auc"))


def _auc(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AUC per class from average ranks of the distinct scores."""
    key = [*by, "__class"]
    known = long.where(F.col("__pos").isNotNull() & F.col("__s").isNotNull())
    per_score = known.groupBy(*key, "__s").agg(F.count(F.lit(1)).alias("n"), F.sum("__pos").alias("p"))
    ranked = Ordered(per_score, key, ["__s"]).running_sum(__upto=F.col("n"))
    rank = F.col("__upto") - F.col("n") + (F.col("n") + 1) / 2
    sums = ranked.groupBy(*key).agg(
        F.sum(F.col("p") * rank).alias("s"),
        F.sum("p").cast("double").alias("pos"),
        F.sum(F.col("n") - F.col("p")).cast("double").alias("neg"),
    )
    pos, neg = F.col("pos"), F.col("neg")
    return sums.select(*key, div(F.col("s") - pos * (pos + 1) / 2, pos * neg).alias("auc"))


def log_loss(df: DataFrame, truth: str, scores: Mapping[float, str]) -> DataFrame:
    """One row ``log_loss`` of the probability given to the true class."""
    given = F.lit(None).cast("double")
    for c, s in scores.items():
        given = F.when(F.col(truth) == F.lit(c), F.col(s)).otherwise(given)
    clipped = F.least(F.greatest(given, F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))
    return df.agg((-F.avg(F.log(F.when(given.isNotNull(), clipped)))).alias("log_loss"))


def regression_metrics(
    df: DataFrame, truth: str = "label", pred: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """One row, or one for each group: mse, rmse, mae, r2 and the share of equal signs."""
    y, p = F.col(truth).cast("double"), F.col(pred).cast("double")
    known = df.where(y.isNotNull() & p.isNotNull())
    sums = known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("__var"),
        F.avg((F.signum(y) == F.signum(p)).cast("double")).alias("directional_accuracy"),
    )
    return sums.select(
        *by, "n", "mse", F.sqrt("mse").alias("rmse"), "mae", (1 - div("mse", "__var")).alias("r2"), "directional_accuracy"
    )


def evaluate_classifier(df: DataFrame, truth: str, pred: str, scores: Mapping[float, str]) -> DataFrame:
    """Accuracy, precision, recall, F1, AUC and log loss in one row."""
    out = classification_metrics(df, truth, pred)
    if len(scores) == 2:
        top = max(scores)
        area = auc(df, F.col(truth) == F.lit(top), scores[top])
    else:
        area = auc_ovr(df, truth, scores)
    return out.withColumns({"auc": area.scalar(), "log_loss": log_loss(df, truth, scores).scalar()})


def evaluate_groups(df: DataFrame, by: str, truth: str, pred: str, classes: str, scores: str) -> DataFrame:
    """The same for every group at once. Groups may have classes of their own: ``classes`` and
    ``scores`` are arrays of class values and their probabilities."""
    one = F.transform(
        F.arrays_zip(F.col(classes).alias("c"), F.col(scores).alias("s")),
        lambda x: F.struct(x["c"].alias("__class"), (F.col(truth) == x["c"]).cast("int").alias("__pos"), x["s"].alias("__s")),
    )
    area = _auc(df.select(by, F.explode(one).alias("x")).select(by, "x.*"), [by]).groupBy(by).agg(F.avg("auc").alias("auc"))
    given = F.get(scores, F.array_position(classes, F.col(truth).cast("double")).cast("int") - 1)
    clipped = F.least(F.greatest(given, F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))
    loss = df.groupBy(by).agg((-F.avg(F.log(F.when(given.isNotNull(), clipped)))).alias("log_loss"))
    out = classification_metrics(df, truth, pred, [by])
    for part in (area, loss):
        part = part.withColumnRenamed(by, "__by")
        out = out.join(part, F.col(by).eqNullSafe(F.col("__by")), "left").drop("__by")
    return out


# -- baselines --------------------------------------------------------------------------


def zero_mse(df: DataFrame, target: str) -> DataFrame:
    """MSE of always predicting 0."""
    return df.agg(F.avg(F.col(target) * F.col(target)).alias("mse_pred0"))


def mean_mae(df: DataFrame, target: str) -> DataFrame:
    """MAE of always predicting the mean."""
    mean = df.agg(F.avg(target)).scalar()
    return df.withColumn("__m", mean).agg(F.avg(F.abs(F.col(target) - F.col("__m"))).alias("mae_predmean"))


def majority_baseline(df: DataFrame, target: str) -> DataFrame:
    """Accuracy and balanced accuracy of always predicting the commonest class."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        div(F.max("n"), F.sum("n")).alias("acc_majority"),
        div(F.lit(1.0), F.count(F.lit(1))).alias("bal_acc_majority"),
    )
