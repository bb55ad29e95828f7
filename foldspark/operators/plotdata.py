"""The numbers behind plots: every plot of many rows is a small aggregate."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from foldspark.functions.distributions import normal_quantile_column
from foldspark.operators.gram import Member, grams
from foldspark.operators.linear import INTERCEPT, simple_regression_by, solve
from foldspark.operators.ordered import exact_quantiles, grouped_quantiles, positions, running_totals
from foldspark.operators.splines import NaturalSpline, knot_probabilities


def _bin(value: Column, low: float, width: float, bins: int) -> Column:
    """0-based bin; the top edge belongs to the last bin."""
    return F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")


def _range(df: DataFrame, *columns: str) -> list[tuple[float, float]]:
    row = df.agg(
        *[f(c).cast("double").alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    return [(row[f"lo{i}"], row[f"hi{i}"]) for i in range(len(columns))]


def histogram(
    df: DataFrame, column: str, bins: int = 50, log10: bool = False, by: list[str] | None = None
) -> DataFrame:
    """(by, bin, bin_low, n) of equal-width bins, on the log axis if asked.

    ``by`` gives one panel per group on a shared axis.
    """
    by = by or []
    x = F.col(column).cast("double")
    value = F.when(x > 0, F.log10(x)) if log10 else x
    rows = df.select(*by, value.alias("x")).where("x is not null")
    ((low, high),) = _range(rows, "x")
    width = (high - low) / bins if high > low else 1.0
    counted = rows.groupBy(*by, _bin(F.col("x"), low, width, bins).alias("bin"))
    return counted.agg(F.count("*").alias("n")).withColumn("bin_low", F.lit(low) + F.col("bin") * width)


def binned_scatter(df: DataFrame, x: str, y: str, bins: int = 30) -> DataFrame:
    """Two-way bin counts of a scatter plot."""
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    (xl, xh), (yl, yh) = _range(rows, "x", "y")
    xw = (xh - xl) / bins if xh > xl else 1.0
    yw = (yh - yl) / bins if yh > yl else 1.0
    return rows.groupBy(
        _bin(F.col("x"), xl, xw, bins).alias("x_bin"), _bin(F.col("y"), yl, yw, bins).alias("y_bin")
    ).agg(F.count("*").alias("n"))


def group_lines(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """End points of the least-squares line of every group."""
    tidy = simple_regression_by(df, by, y, x)
    line = tidy.groupBy(*by).agg(
        F.max(F.when(F.col("term") == INTERCEPT, F.col("estimate"))).alias("a"),
        F.max(F.when(F.col("term") == x, F.col("estimate"))).alias("b"),
    )
    complete = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ends = complete.groupBy(*by).agg(
        F.min(x).cast("double").alias("x_min"), F.max(x).cast("double").alias("x_max")
    )
    at = F.array(F.col("x_min"), F.col("x_max"))
    joined = line.join(ends, by).select(*by, "a", "b", F.explode(at).alias("x"))
    return joined.select(*by, "x", (F.col("a") + F.col("b") * F.col("x")).alias("y"))


def smoother(df: DataFrame, x: str, y: str, deg_free: list[int], points: int = 100) -> DataFrame:
    """Natural-spline curves for several degrees of freedom, on one grid.

    All knots come from one quantile pass and all fits from one cross-product pass.
    """
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    grid = sorted({p for k in deg_free for p in knot_probabilities(k)})
    found = dict(zip(grid, exact_quantiles(rows, "x", grid)["all"]))
    splines = {k: NaturalSpline([found[p] for p in knot_probabilities(k)]) for k in deg_free}
    members = {
        str(k): Member(F.concat(s.column(F.col("x")), F.array(F.col("y"))), s.size + 1, ("all",))
        for k, s in splines.items()
    }
    sums = grams(rows, {"all": F.lit(1)}, members)
    at = np.linspace(found[0.0], found[1.0], points)
    out = []
    for k, spline in splines.items():
        fit = solve(sums[str(k), "all"], [f"ns_{i}" for i in range(spline.size)])
        curve = spline.values(at) @ np.nan_to_num(fit.estimate[1:]) + fit.estimate[0]
        out += [(int(k), float(a), float(v)) for a, v in zip(at, curve)]
    return df.sparkSession.createDataFrame(out, "deg_free int, x double, y double")


def residuals(scored: DataFrame, truth: str, estimate: str = "pred") -> DataFrame:
    """Adds ``residual`` next to the fitted value."""
    return scored.withColumn("residual", F.col(truth) - F.col(estimate))


def normal_quantiles(df: DataFrame, column: str) -> DataFrame:
    """Each distinct value with the normal quantile of its middle rank."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    total = df.agg(F.count(column).alias("n")).first()["n"]
    ranked = running_totals(counts, "value", ["n"])
    middle = (F.col("cum_n") - F.col("n") / 2.0) / F.lit(float(total))
    return ranked.select("value", "n", normal_quantile_column(middle).alias("normal_quantile"))


def ordered_levels(df: DataFrame, level: str, statistic: Column | None = None, median_of: str | None = None) -> DataFrame:
    """Levels with the order their statistic, or the median of a column, gives them; ties in level order."""
    if (statistic is None) == (median_of is None):
        raise ValueError("give a statistic or the column whose median orders the levels")
    if median_of is None:
        stats = df.groupBy(level).agg(statistic.alias("statistic"))
    else:
        stats = grouped_quantiles(df, [level], median_of, [0.5]).select(level, F.get("quantiles", F.lit(0)).alias("statistic"))
    return positions(stats, ["statistic", level], "order").withColumn("order", F.col("order").cast("int"))
