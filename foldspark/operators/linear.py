"""Least squares with full inference, from cross-products."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldspark.functions.constants import array_constant
from foldspark.functions.distributions import (
    f_upper,
    t_quantile,
    t_quantiles,
    t_two_sided,
    t_two_sided_udf,
)
from foldspark.operators.gram import Gram, gram

INTERCEPT = "(Intercept)"
# share of a column's variation that must remain after the columns before it
_ALIAS_TOLERANCE = 1e-11


def independent_columns(cross: np.ndarray, tolerance: float = _ALIAS_TOLERANCE) -> list[int]:
    """Columns, in order, that are not linear combinations of earlier ones."""
    left = np.array(cross, dtype=float)
    start = np.diag(left).copy()
    kept = []
    for j in range(len(left)):
        pivot = left[j, j]
        if start[j] <= 0 or not pivot > tolerance * start[j]:
            continue
        kept.append(j)
        left = left - np.outer(left[:, j], left[j, :]) / pivot
    return kept


@dataclass(frozen=True)
class LinearFit:
    """A fitted linear model; aliased terms have a NaN estimate."""

    terms: tuple[str, ...]
    estimate: np.ndarray
    unscaled: np.ndarray  # inverse of X'X, NaN for aliased terms
    n: float
    rank: int
    rss: float
    tss: float

    @property
    def df_residual(self) -> float:
        return self.n - self.rank

    @property
    def sigma2(self) -> float:
        return self.rss / self.df_residual if self.df_residual > 0 else float("nan")

    @property
    def r_squared(self) -> float:
        return 1.0 - self.rss / self.tss if self.tss > 0 else float("nan")

    @property
    def std_error(self) -> np.ndarray:
        return np.sqrt(self.sigma2 * np.diag(self.unscaled))

    def tidy_rows(self, level: float = 0.95) -> list[dict]:
        """Coefficient table as plain rows."""
        se = self.std_error
        with np.errstate(all="ignore"):
            statistic = self.estimate / se
        p = t_two_sided(np.nan_to_num(statistic), max(self.df_residual, 1.0))
        half = t_quantile(0.5 + level / 2.0, self.df_residual) * se if self.df_residual > 0 else se
        rows = []
        for i, term in enumerate(self.terms):
            known = np.isfinite(statistic[i])
            rows.append(
                {
                    "term": term,
                    "estimate": _plain(self.estimate[i]),
                    "std_error": _plain(se[i]),
                    "statistic": _plain(statistic[i]),
                    "p_value": float(p[i]) if known else None,
                    "conf_low": _plain(self.estimate[i] - half[i]),
                    "conf_high": _plain(self.estimate[i] + half[i]),
                }
            )
        return rows

    def tidy(self, spark: SparkSession, level: float = 0.95) -> DataFrame:
        return spark.createDataFrame([tuple(r.values()) for r in self.tidy_rows(level)], TIDY_SCHEMA)

    def vcov(self, spark: SparkSession) -> DataFrame:
        """Coefficient covariances, one row per pair of terms."""
        cov = self.sigma2 * self.unscaled
        rows = [
            (a, b, _plain(cov[i, j]))
            for i, a in enumerate(self.terms)
            for j, b in enumerate(self.terms)
        ]
        return spark.createDataFrame(rows, "term_1 string, term_2 string, covariance double")

    def interval(self, fit: Column, vector: Column, level: float = 0.95) -> tuple[Column, Column]:
        """Bounds for one new observation with this prediction and design vector."""
        quadratic = leverage(self.unscaled)(vector)
        half = t_quantile(0.5 + level / 2.0, self.df_residual) * F.sqrt(
            F.lit(self.sigma2) * (F.lit(1.0) + quadratic)
        )
        return fit - half, fit + half


TIDY_SCHEMA = (
    "term string, estimate double, std_error double, statistic double, "
    "p_value double, conf_low double, conf_high double"
)


def _plain(value: float) -> float | None:
    return float(value) if np.isfinite(value) else None


def leverage(unscaled: np.ndarray):
    """x' M x per row of a design (an array without the intercept), M being the inverse cross-products.

    M is factorised once, so that a batch of rows is one product with a triangle; aliased terms, NaN in M, add nothing.
    """
    kept = np.flatnonzero(~np.isnan(np.diag(unscaled)))
    inverse = unscaled[np.ix_(kept, kept)]
    scale = np.sqrt(np.diag(inverse))
    factor = np.linalg.cholesky(inverse / np.outer(scale, scale)) * scale[:, None]
    step = max(1, _SLICE // max(len(unscaled), 1))

    @F.pandas_udf("double")
    def of(vectors: pd.Series) -> pd.Series:
        out = np.full(len(vectors), np.nan)
        known = np.flatnonzero(vectors.notna())
        for begin in range(0, len(known), step):
            at = known[begin : begin + step]
            x = np.ones((len(at), len(unscaled)))
            x[:, 1:] = np.stack([np.asarray(v, float) for v in vectors.iloc[at]]).reshape(len(at), -1)
            out[at] = ((x[:, kept] @ factor) ** 2).sum(axis=1)
        return pd.Series(out, index=vectors.index)

    return of


#: Doubles of a slice of rows.
_SLICE = 1 << 22


def dot_columns(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, v: total + v)


def dot(vector: Column, weights: np.ndarray) -> Column:
    if len(weights) == 0:
        return F.lit(0.0)
    return dot_columns(vector, array_constant([float(v) for v in weights]))


def solve(sums: Gram, terms: list[str] | tuple[str, ...]) -> LinearFit:
    """Least squares of the last column on the others, with intercept."""
    p = len(terms)
    sxx, sxy, syy = sums.cross[:p, :p], sums.cross[:p, p], sums.cross[p, p]
    kept = independent_columns(sxx)
    scale = np.sqrt(np.diag(sxx)[kept])
    slopes = np.full(p, np.nan)
    unscaled = np.full((p + 1, p + 1), np.nan)
    mean = sums.mean[:p]
    rss = syy
    if kept:
        inverse = np.linalg.inv(sxx[np.ix_(kept, kept)] / np.outer(scale, scale))
        inverse = inverse / np.outer(scale, scale)
        slopes[kept] = inverse @ sxy[kept]
        rss = syy - sxy[kept] @ slopes[kept]
        at = np.array(kept) + 1
        unscaled[np.ix_(at, at)] = inverse
        unscaled[0, at] = unscaled[at, 0] = -inverse @ mean[kept]
        unscaled[0, 0] = 1.0 / sums.n + mean[kept] @ inverse @ mean[kept]
    else:
        unscaled[0, 0] = 1.0 / sums.n if sums.n else np.nan
    intercept = sums.mean[p] - np.nan_to_num(slopes) @ mean
    return LinearFit(
        (INTERCEPT, *terms),
        np.concatenate([[intercept], slopes]),
        unscaled,
        float(sums.n),
        len(kept) + 1,
        float(max(rss, 0.0)),
        float(syy),
    )


#: Sweeps of the coordinate descent, and the change at which it ends, relative to the largest covariance.
_SWEEPS, _STILL = 100_000, 1e-12


def elastic_net(sums: Gram, terms: list[str] | tuple[str, ...], penalty: float, mixture: float = 1.0) -> LinearFit:
    """Penalised least squares of the last column on the others, by coordinate descent on the cross-products.

    Minimises RSS / 2n + penalty * (mixture * |b| + (1 - mixture) / 2 * b^2), b being the slopes per standard
    deviation (divisor n); the slopes returned are those of the raw columns. Constant columns have slope 0.
    The rows are not read again, whatever the number of penalties. There is no inference.
    """
    p, n = len(terms), sums.n
    spread = np.sqrt(np.diag(sums.cross)[:p] / n) if n else np.zeros(p)
    live = np.flatnonzero(spread > 1e-12 * np.maximum(np.abs(sums.mean[:p]), 1e-300))
    scale = spread[live]
    own = sums.cross[np.ix_(live, live)] / n / np.outer(scale, scale)
    rest = sums.cross[live, p] / n / scale  # covariance of each column with what is left of the outcome
    slopes, limit = np.zeros(len(live)), penalty * mixture
    ridge = penalty * (1.0 - mixture)
    still = _STILL * max(float(np.abs(rest).max(initial=0.0)), 1e-300)
    for _ in range(_SWEEPS):
        largest = 0.0
        for j in range(len(live)):
            pull = rest[j] + own[j, j] * slopes[j]
            new = np.sign(pull) * max(abs(pull) - limit, 0.0) / (own[j, j] + ridge)
            change = new - slopes[j]
            if change:
                rest -= own[:, j] * change
                slopes[j] = new
                largest = max(largest, abs(change))
        if largest <= still:
            break
    else:
        warnings.warn(f"the elastic net still moves after {_SWEEPS} sweeps", stacklevel=2)
    estimate = np.zeros(p + 1)
    estimate[live + 1] = slopes / scale
    estimate[0] = sums.mean[p] - estimate[1:] @ sums.mean[:p] if n else np.nan
    unknown = np.full((p + 1, p + 1), np.nan)
    return LinearFit((INTERCEPT, *terms), estimate, unknown, float(n), p + 1, float("nan"), float("nan"))


def fit_columns(df: DataFrame, outcome: str, predictors: list[str]) -> LinearFit:
    """The matrix interface: least squares on numeric columns as they are."""
    vector = F.array(*[F.col(c).cast("double") for c in [*predictors, outcome]])
    return solve(gram(df, vector, len(predictors) + 1), predictors)


def nested_f_test(spark: SparkSession, small: LinearFit, big: LinearFit) -> DataFrame:
    """Compare nested models by the drop in residual sum of squares."""
    extra = int(big.rank - small.rank)
    drop = float(small.rss - big.rss)
    f = float(drop / extra / big.sigma2) if extra > 0 and big.sigma2 > 0 else None
    p = float(f_upper(f, extra, big.df_residual)) if f is not None else None
    rows = [
        ("small", float(small.df_residual), small.rss, None, None, None, None),
        ("big", float(big.df_residual), big.rss, float(extra), drop, f, p),
    ]
    return spark.createDataFrame(
        rows,
        "model string, df_residual double, rss double, df double, sumsq double, "
        "statistic double, p_value double",
    )


# ---------------------------------------------------------------- one model per group

def simple_regression_by(df: DataFrame, by: list[str], y: str, x: str) -> DataFrame:
    """Intercept and slope of y on x for every group: one aggregation, no Python.

    A group that fills a third of the table is combined map-side like any other.
    """
    complete = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    sums = complete.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(xd).alias("x_mean"),
        F.regr_sxx(yd, xd).alias("sxx"),
        F.regr_syy(yd, xd).alias("syy"),
        F.regr_sxy(yd, xd).alias("sxy"),
        F.avg(yd).alias("y_mean"),
    )
    # a constant predictor has no slope and takes no degree of freedom
    slope = F.try_divide("sxy", "sxx")
    explained = F.coalesce(F.col("slope") * F.col("sxy"), F.lit(0.0))
    free = F.col("n") - F.when(F.col("slope").isNull(), 1).otherwise(2)
    rest = F.greatest(F.col("syy") - explained, F.lit(0.0))
    solved = sums.withColumn("slope", slope).withColumn("mse", F.when(free > 0, rest / free))
    reach = F.coalesce(F.try_divide(F.col("x_mean") ** 2, F.col("sxx")), F.lit(0.0))
    intercept_se = F.sqrt(F.col("mse") * (F.lit(1.0) / F.col("n") + reach))
    rows = F.array(
        _term(INTERCEPT, F.col("y_mean") - F.coalesce("slope", F.lit(0.0)) * F.col("x_mean"), intercept_se),
        _term(x, F.col("slope"), F.sqrt(F.try_divide("mse", "sxx"))),
    )
    return solved.select(*by, "n", F.explode(rows).alias("t")).select(
        *by,
        "t.term",
        "t.estimate",
        "t.std_error",
        F.try_divide("t.estimate", "t.std_error").alias("statistic"),
        "n",
    )


def _term(name: str, estimate: Column, error: Column) -> Column:
    return F.struct(
        F.lit(name).alias("term"), estimate.alias("estimate"), error.alias("std_error")
    )


def with_p_value(tidy: DataFrame, parameters: int) -> DataFrame:
    """Two-sided p-values for a coefficient table of any length."""
    return tidy.withColumn(
        "p_value", t_two_sided_udf(F.col("statistic"), (F.col("n") - parameters).cast("double"))
    )


def regression_by(df: DataFrame, by: list[str], y: str, xs: list[str]) -> DataFrame:
    """Least squares on several predictors for every group, however many groups.

    Rows are reduced to cross-products by a normal aggregation; a vectorised
    kernel then solves one small system per group.
    """
    columns = [*xs, y]
    complete = df.dropna(subset=columns).select(
        *by, *[F.col(c).cast("double").alias(c) for c in columns]
    )
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    packed = complete.groupBy(*by).agg(
        F.count("*").alias("__n"),
        F.array(*[F.avg(c) for c in columns]).alias("__means"),
        F.array(*[F.covar_pop(columns[i], columns[j]) for i, j in pairs]).alias("__cells"),
    )
    size = len(columns)
    names = list(xs)

    def kernel(frames):
        for frame in frames:
            keys, numbers = [], []
            for group, n, mean, cells in zip(
                frame[by].itertuples(index=False), frame["__n"], frame["__means"], frame["__cells"]
            ):
                cross = np.zeros((size, size))
                for (i, j), v in zip(pairs, cells):
                    cross[i, j] = cross[j, i] = v * n
                fit = solve(Gram(float(n), np.asarray(mean, dtype=float), cross), names)
                for term, b, se in zip(fit.terms, fit.estimate, fit.std_error):
                    keys.append((*group, term))
                    numbers.append((b, se, fit.df_residual, n))
            table = pd.DataFrame(keys, columns=[*by, "term"])
            b, se, free, n = np.array(numbers, dtype=float).reshape(-1, 4).T
            with np.errstate(all="ignore"):
                statistic = b / se
            known = np.isfinite(statistic) & (free > 0)
            tail = t_two_sided(np.where(known, statistic, 0.0), np.where(known, free, 1.0))
            half = t_quantiles(0.975, np.maximum(free, 1.0)) * se
            columns = (b, se, statistic, np.where(known, tail, np.nan), b - half, b + half)
            for name, values in zip(_TIDY_NAMES[1:], columns):
                table[name] = pd.array(values, dtype="Float64")
                table.loc[~np.isfinite(values), name] = pd.NA
            table["n"] = n.astype("int64")
            yield table

    keys_ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packed.select(*by).schema)
    return packed.mapInPandas(kernel, f"{keys_ddl}, {TIDY_SCHEMA}, n long")


_TIDY_NAMES = [part.split()[0] for part in TIDY_SCHEMA.split(", ")]
