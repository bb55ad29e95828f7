"""Regression and classification metrics as single aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

REGRESSION = ("rmse", "rsq", "mae")
CLASSIFICATION = ("accuracy", "mcc", "f_meas")


def _regression(name: str, truth: Column, estimate: Column) -> Column:
    gap = truth - estimate
    if name == "rmse":
        return F.sqrt(F.avg(gap * gap))
    if name == "mae":
        return F.avg(F.abs(gap))
    if name == "rsq":
        varied = (F.var_pop(truth) > 0) & (F.var_pop(estimate) > 0)
        # covariance over standard deviations: no error on a constant column
        shared = F.covar_pop(truth, estimate)
        spread = F.var_pop(truth) * F.var_pop(estimate)
        return F.when(varied, F.try_divide(shared * shared, spread))
    raise ValueError(f"unknown regression metric: {name}")


def regression_metrics(
    df: DataFrame,
    truth: str,
    estimate: str,
    metrics: tuple[str, ...] = REGRESSION,
    by: list[str] | None = None,
) -> DataFrame:
    """Long table (by, metric, estimator, estimate); pairs with a NULL are left out."""
    by = by or []
    t, e = F.col(truth).cast("double"), F.col(estimate).cast("double")
    complete = df.where(t.isNotNull() & e.isNotNull())
    wide = complete.groupBy(*by).agg(*[_regression(m, t, e).alias(f"__{m}") for m in metrics])
    return _long(wide, by, {m: ("standard", F.col(f"__{m}")) for m in metrics})


def _long(wide: DataFrame, by: list[str], values: dict[str, tuple[str, Column]]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(name).alias("metric"),
            F.lit(estimator).alias("estimator"),
            value.cast("double").alias("estimate"),
        )
        for name, (estimator, value) in values.items()
    ]
    return wide.select(*by, F.explode(F.array(*entries)).alias("m")).select(
        *by, "m.metric", "m.estimator", "m.estimate"
    )


# ---------------------------------------------------------------- classification

def confusion_counts(df: DataFrame, truth: str, estimate: str, by: list[str] | None = None) -> DataFrame:
    """(by, truth, estimate, n): the one aggregation all class metrics share."""
    by = by or []
    complete = df.where(F.col(truth).isNotNull() & F.col(estimate).isNotNull())
    return complete.groupBy(
        *by,
        F.col(truth).cast("string").alias("truth"),
        F.col(estimate).cast("string").alias("estimate"),
    ).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, truth: str, estimate: str, levels: list[str]) -> DataFrame:
    """Every pair of levels, zeros included: the counts plus a grid of zeros."""
    grid = F.array(
        *[
            F.struct(F.lit(t).alias("truth"), F.lit(e).alias("estimate"), F.lit(0).cast("long").alias("n"))
            for t in levels
            for e in levels
        ]
    )
    zeros = df.sparkSession.range(1).select(F.inline(grid))
    counted = confusion_counts(df, truth, estimate)
    return counted.unionByName(zeros).groupBy("truth", "estimate").agg(F.sum("n").alias("n"))


def class_totals(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per level: rows of that truth, rows predicted so, and rows right."""
    by = by or []
    sides = F.array(
        F.struct(
            F.col("truth").alias("level"),
            F.col("n").alias("actual"),
            F.lit(0).cast("long").alias("predicted"),
            F.when(F.col("truth") == F.col("estimate"), F.col("n")).otherwise(0).alias("right"),
        ),
        F.struct(
            F.col("estimate").alias("level"),
            F.lit(0).cast("long").alias("actual"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("long").alias("right"),
        ),
    )
    return (
        counts.select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, F.col("s.level").alias("level"))
        .agg(
            F.sum("s.actual").alias("actual"),
            F.sum("s.predicted").alias("predicted"),
            F.sum("s.right").alias("right"),
        )
    )


def classification_metrics(
    df: DataFrame,
    truth: str,
    estimate: str,
    levels: list[str],
    metrics: tuple[str, ...] = CLASSIFICATION,
    by: list[str] | None = None,
    event_level: str = "first",
) -> DataFrame:
    """accuracy, mcc (general formula) and f_meas (two levels) from one count.

    The event is the first level unless ``event_level`` is ``second``.
    """
    by = by or []
    if event_level not in ("first", "second"):
        raise ValueError("event_level is first or second")
    if "f_meas" in metrics and len(levels) != 2:
        raise ValueError("f_meas needs exactly two levels")
    event = levels[0] if event_level == "first" else levels[1]
    totals = class_totals(confusion_counts(df, truth, estimate, by), by)
    a, p, r = (F.col(c).cast("double") for c in ("actual", "predicted", "right"))
    is_event = F.col("level") == F.lit(event)
    wide = totals.groupBy(*by).agg(
        F.sum(a).alias("n"),
        F.sum(r).alias("hits"),
        F.sum(a * p).alias("ap"),
        F.sum(a * a).alias("aa"),
        F.sum(p * p).alias("pp"),
        F.sum(F.when(is_event, r)).alias("tp"),
        F.sum(F.when(is_event, a)).alias("event_actual"),
        F.sum(F.when(is_event, p)).alias("event_predicted"),
    )
    estimator = "binary" if len(levels) == 2 else "multiclass"
    n2 = F.col("n") * F.col("n")
    spread = F.sqrt((n2 - F.col("pp")) * (n2 - F.col("aa")))
    formulas = {
        "accuracy": F.try_divide("hits", "n"),
        "mcc": F.try_divide(F.col("hits") * F.col("n") - F.col("ap"), spread),
        "f_meas": F.try_divide(2 * F.col("tp"), F.col("event_actual") + F.col("event_predicted")),
    }
    return _long(wide, by, {m: (estimator, formulas[m]) for m in metrics})


def sensitivity(df: DataFrame, truth: str, estimate: str, by: list[str] | None = None) -> DataFrame:
    """Multiclass sensitivity: macro, macro_weighted and micro averages.

    A class with no right prediction counts as zero.
    """
    by = by or []
    totals = class_totals(confusion_counts(df, truth, estimate, by), by).where("actual > 0")
    own = F.col("right") / F.col("actual")
    wide = totals.groupBy(*by).agg(
        F.avg(own).alias("macro"),
        F.try_divide(F.sum(own * F.col("actual")), F.sum("actual")).alias("macro_weighted"),
        F.try_divide(F.sum("right"), F.sum("actual")).alias("micro"),
    )
    entries = [
        F.struct(F.lit(e).alias("estimator"), F.col(e).cast("double").alias("estimate"))
        for e in ("macro", "macro_weighted", "micro")
    ]
    return wide.select(
        *by, F.lit("sensitivity").alias("metric"), F.explode(F.array(*entries)).alias("m")
    ).select(*by, "metric", "m.estimator", "m.estimate")


def sensitivity_by_hand(df: DataFrame, truth: str, estimate: str) -> DataFrame:
    """The same three averages as a chain of counts, a filter and a full join.

    Here a class with no right prediction has a missing sensitivity, and a plain
    mean of values with a missing one is missing.
    """
    cells = confusion_counts(df, truth, estimate)
    totals = df.groupBy(F.col(truth).cast("string").alias("truth")).agg(F.count("*").alias("totals"))
    share = share_of_total(totals, "totals", "class_wts")
    joined = cells.where(F.col("truth") == F.col("estimate")).join(share, "truth", "full")
    sens = F.col("n") / F.col("totals")
    whole = F.count(sens) == F.count("*")
    return joined.agg(
        F.when(whole, F.avg(sens)).alias("macro"),
        F.when(whole, F.try_divide(F.sum(sens * F.col("class_wts")), F.sum("class_wts"))).alias("macro_wts"),
        F.when(whole, F.try_divide(F.sum("n"), F.sum("totals"))).alias("micro"),
    )


def share_of_total(counts: DataFrame, column: str, name: str) -> DataFrame:
    """Each row's share of the column total, the total being a scalar subquery."""
    total = counts.agg(F.sum(column).cast("double")).scalar()
    return counts.withColumn(name, F.try_divide(F.col(column).cast("double"), total))


def performance_report(
    scored: DataFrame, truth: str, estimate: str, object_name: str, data_name: str
) -> DataFrame:
    """rmse and rsq of a scored table, labelled with model and data names."""
    table = regression_metrics(scored, truth, estimate, ("rmse", "rsq")).drop("estimator")
    return table.withColumns({"object": F.lit(object_name), "data": F.lit(data_name)})


# ---------------------------------------------------------------- over resamples

def summarize_metrics(per_resample: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean, number of resamples and standard error of each metric."""
    by = by or []
    return per_resample.groupBy(*by, "metric", "estimator").agg(
        F.avg("estimate").alias("mean"),
        F.count("estimate").alias("n"),
        F.try_divide(F.stddev_samp("estimate"), F.sqrt(F.count("estimate"))).alias("std_err"),
    )
