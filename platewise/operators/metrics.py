"""Model scores and residual statistics as grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.constants import COVERAGE_Z, EPS, METRIC_NAMES, OVERFIT_GAP, UNDERFIT_R2
from platewise.functions.numeric import inverse_normal, normal_cdf
from platewise.operators.ranking import value_positions
from platewise.operators.sizing import small_side


def r2(truth: Column, prediction: Column) -> Column:
    """Coefficient of determination. ``var_pop * n`` is the spread around the mean, found in the same pass.

    A constant truth scores 1 when every prediction is exact, else 0.
    """
    error = F.sum((truth - prediction) * (truth - prediction))
    spread = F.var_pop(truth) * F.count(truth)
    return F.when(spread > 0, F.lit(1.0) - error / spread).otherwise(F.when(error == 0, 1.0).otherwise(0.0))


def rmse(truth: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg((truth - prediction) * (truth - prediction)))


def regression_metrics(
    df: DataFrame,
    by: Sequence[str] = ("target", "split"),
    truth_log: str = "y_log",
    prediction_log: str = "pred_log",
    truth: str = "y",
    factor: str | None = "norm",
) -> DataFrame:
    """The six scores per group, in one pass. ``mape`` is a fraction.

    ``factor`` takes a prediction from normalised log space back to physical units.
    """
    scored = df.withColumn(
        "_pred", F.pow(F.lit(10.0), F.col(prediction_log)) * (F.col(factor) if factor else F.lit(1.0))
    )
    tl, pl, t, p = F.col(truth_log), F.col(prediction_log), F.col(truth), F.col("_pred")
    values = {
        "r2_log": r2(tl, pl),
        "rmse_log": rmse(tl, pl),
        "mae_log": F.avg(F.abs(tl - pl)),
        "r2_orig": r2(t, p),
        "rmse_orig": rmse(t, p),
        "mape": F.avg(F.abs(t - p) / (F.abs(t) + EPS)),
    }
    return scored.groupBy(*by).agg(*[values[m].alias(m) for m in METRIC_NAMES])


def mape_positive(df: DataFrame, by: Sequence[str], truth: str = "y", prediction: str = "pred") -> DataFrame:
    """Percent error over rows whose truth is positive."""
    t, p = F.col(truth), F.col(prediction)
    return df.filter(t > 0).groupBy(*by).agg((F.avg(F.abs((t - p) / t)) * 100).alias("mape_pct"))


def mean_baseline(df: DataFrame, by: Sequence[str], truth: str = "y_log") -> DataFrame:
    """Scores of predicting the mean of the evaluated rows: R2 is 0, RMSE their population spread."""
    return df.groupBy(*by).agg(
        F.when(F.var_pop(truth) > 0, 0.0).otherwise(1.0).alias("r2_log"), F.stddev_pop(truth).alias("rmse_log")
    )


def fit_diagnosis(metrics: DataFrame, by: Sequence[str] = ("target",), score: str = "r2_log") -> DataFrame:
    """Train, val and test score side by side with a verdict."""
    wide = metrics.groupBy(*by).agg(
        *[F.max(F.when(F.col("split") == s, F.col(score))).alias(f"r2_{s}") for s in ("train", "val", "test")]
    )
    gap = F.col("r2_train") - F.col("r2_test")
    verdict = F.when(gap > OVERFIT_GAP, "overfit").when(F.col("r2_test") < UNDERFIT_R2, "underfit").otherwise("ok")
    return wide.withColumns({"gap": gap, "diagnosis": verdict})


def metrics_tidy(nested: DataFrame, column: str = "splits") -> DataFrame:
    """Nested ``target -> {split: {metric: value}}`` to one row per target and split."""
    return (
        nested.select("target", F.explode(column).alias("split", "_m"))
        .select("target", "split", *[F.col("_m")[m].alias(m) for m in METRIC_NAMES])
    )


def metrics_nested(metrics: DataFrame) -> DataFrame:
    """Tidy rows to ``target -> {split: {metric: value}}``; a target has a handful of splits."""
    values = F.map_from_arrays(F.array(*[F.lit(m) for m in METRIC_NAMES]), F.array(*METRIC_NAMES))
    return metrics.groupBy("target").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("split"), values.alias("m")))).alias("splits")
    )


def model_comparison(metrics: DataFrame, models: Sequence[str], score: str = "r2_log") -> DataFrame:
    """One row per target, one column per model."""
    return metrics.groupBy("target").pivot("model", list(models)).agg(F.first(score))


def residual_stats(df: DataFrame, by: Sequence[str], residual: Column) -> DataFrame:
    return df.groupBy(*by).agg(
        F.avg(residual).alias("mean_residual"), F.stddev_pop(residual).alias("std_residual"), F.count(residual).alias("n")
    )


def interval_coverage(df: DataFrame, by: Sequence[str], residual: Column, z: float = COVERAGE_Z) -> DataFrame:
    """Percent of residuals within ``z`` standard deviations, by group."""
    rows = df.select(*by, residual.alias("_e")).filter(F.col("_e").isNotNull())
    sigma = rows.groupBy(*by).agg(F.stddev_pop("_e").alias("sigma"))
    inside = F.abs(F.col("_e")) <= F.lit(z) * F.col("sigma")
    return (
        rows.join(small_side(sigma), list(by))
        .groupBy(*by)
        .agg(F.first("sigma").alias("sigma"), (F.avg(inside.cast("double")) * 100).alias("coverage_pct"))
    )


def qq_points(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., value, n, theoretical)``: distinct values with the normal quantile of their mean position.

    Positions follow Filliben: (i - 0.3175) / (n + 0.365), with 0.5**(1/n) at the ends. Equal values share
    the mean of their positions.
    """
    total = F.col("total")
    middle = F.col("before") + (F.col("n") + 1) / 2.0
    top = F.pow(F.lit(0.5), F.lit(1.0) / total)
    position = (
        F.when(F.col("before") + F.col("n") == total, F.when(F.col("n") == 1, top))
        .when((F.col("before") == 0) & (F.col("n") == 1), F.lit(1.0) - top)
    )
    position = F.coalesce(position, (middle - 0.3175) / (total + 0.365))
    return value_positions(df, value, by).select(
        *by, value, "n", "total", inverse_normal(position).alias("theoretical")
    )


def qq_line(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and correlation of the Q-Q points, each distinct value weighted by its count."""
    x, y, w = F.col("theoretical"), F.col(value), F.col("n")
    sums = qq_points(df, value, by).groupBy(*by).agg(
        F.sum(w).alias("n"),
        (F.sum(w * x) / F.sum(w)).alias("_mx"),
        (F.sum(w * y) / F.sum(w)).alias("_my"),
        (F.sum(w * x * y) / F.sum(w)).alias("_xy"),
        (F.sum(w * x * x) / F.sum(w)).alias("_xx"),
        (F.sum(w * y * y) / F.sum(w)).alias("_yy"),
    )
    cov = F.col("_xy") - F.col("_mx") * F.col("_my")
    var_x, var_y = F.col("_xx") - F.col("_mx") * F.col("_mx"), F.col("_yy") - F.col("_my") * F.col("_my")
    slope = cov / var_x
    return sums.select(
        *by,
        "n",
        slope.alias("slope"),
        (F.col("_my") - slope * F.col("_mx")).alias("intercept"),
        (cov / F.sqrt(var_x * var_y)).alias("r"),
    )


def ks_normal(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Kolmogorov-Smirnov statistic of standardised values against N(0, 1), with the asymptotic p-value."""
    rows = df.filter(F.col(value).isNotNull())
    moments = rows.groupBy(*by).agg(F.avg(value).alias("_mu"), F.stddev_pop(value).alias("_sigma"))
    if by:
        standard = rows.join(small_side(moments), list(by)).select(*by, ((F.col(value) - F.col("_mu")) / F.col("_sigma")).alias("z"))
    else:
        m = moments.select(F.struct("_mu", "_sigma").alias("m")).scalar()
        standard = rows.select(((F.col(value) - m["_mu"]) / m["_sigma"]).alias("z"))
    cdf = normal_cdf(F.col("z"))
    above = (F.col("before") + F.col("n")) / F.col("total") - cdf
    below = cdf - F.col("before") / F.col("total")
    gap = value_positions(standard, "z", by).groupBy(*by).agg(
        F.max(F.greatest(above, below)).alias("statistic"), F.max("total").alias("n")
    )
    # Kolmogorov series; a hundred terms are far past double precision.
    t = F.sqrt(F.col("n").cast("double")) * F.col("statistic")
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * t * t),
    )
    p = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return gap.withColumn("p_value", F.when(t < 0.2, 1.0).otherwise(F.greatest(F.least(p, F.lit(1.0)), F.lit(0.0))))


def confusion_matrix(df: DataFrame, truth: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(truth, prediction).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, truth: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    The table is counted once; everything else works on the confusion counts (classes squared).
    """
    counts = confusion_matrix(df, truth, prediction)
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(
                    F.col(truth).cast("string").alias("class"),
                    F.when(F.col(truth) == F.col(prediction), F.col("n")).otherwise(0).alias("hit"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                ),
                F.struct(
                    F.col(prediction).cast("string").alias("class"),
                    F.lit(0).cast("long").alias("hit"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                ),
            )
        ).alias("_s")
    ).select("_s.*")
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    per_class = (
        sides.groupBy("class")
        .agg(F.sum("hit").alias("hit"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
        .withColumns({"precision": zero(F.col("hit"), F.col("predicted")), "recall": zero(F.col("hit"), F.col("support"))})
        .withColumn(
            "f1", zero(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
        )
    )
    weight = F.col("support") / F.sum("support").over(Window.partitionBy())
    weighted = per_class.withColumn("_w", weight)
    total = weighted.agg(
        F.sum("hit").alias("hit"),
        F.sum("support").alias("support"),
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *[F.sum(F.col(m) * F.col("_w")).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")],
    )
    accuracy = F.col("hit") / F.col("support")
    rows = [
        F.struct(F.lit("accuracy").alias("class"), accuracy.alias("precision"), accuracy.alias("recall"), accuracy.alias("f1"), "support")
    ]
    for kind in ("macro", "weighted"):
        rows.append(
            F.struct(
                F.lit(f"{kind} avg").alias("class"),
                *[F.col(f"{kind}_{m}").alias(m) for m in ("precision", "recall", "f1")],
                "support",
            )
        )
    summary = total.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
    return per_class.select("class", "precision", "recall", "f1", "support").unionByName(summary)


def error_rate(df: DataFrame, truth: str = "label", prediction: str = "prediction") -> DataFrame:
    wrong = F.col(truth) != F.col(prediction)
    return df.agg(
        F.count_if(wrong).alias("n_errors"), F.count("*").alias("n"), (F.avg(wrong.cast("double")) * 100).alias("error_pct")
    )
