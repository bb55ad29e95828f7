"""Weibull survival regression, with one scale per stratum.

Newton's method: each iteration is one aggregation of gradient and curvature sums
over the rows, grouped by stratum.
"""

from __future__ import annotations

from dataclasses import dataclass

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldspark.operators.linear import INTERCEPT

_ITERATIONS = 50
_TOLERANCE = 1e-10
_MAX_STRATA = 200


@dataclass(frozen=True)
class SurvivalFit:
    terms: tuple[str, ...]
    estimate: np.ndarray
    std_error: np.ndarray
    scale: dict[str, float]
    log_likelihood: float
    n: int
    iterations: int = 0
    converged: bool = True

    def tidy_rows(self) -> list[tuple]:
        rows = [
            ("location", t, float(b), float(s))
            for t, b, s in zip(self.terms, self.estimate, self.std_error)
        ]
        return rows + [("scale", level, float(v), None) for level, v in self.scale.items()]

    def tidy(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.tidy_rows(), "part string, term string, estimate double, std_error double"
        )

    def predict_median(self, predictors: list[str], stratum: str | None = None) -> Column:
        """Median survival time."""
        location = F.lit(float(self.estimate[0]))
        for name, b in zip(predictors, self.estimate[1:]):
            location = location + F.col(name) * float(b)
        return F.exp(location + self.scale_of(stratum) * float(np.log(np.log(2.0))))

    def scale_of(self, stratum: str | None = None) -> Column:
        """Scale of a row's stratum; missing for one that was not seen."""
        scale = F.lit(None).cast("double")
        for level, value in self.scale.items():
            scale = F.when(
                F.lit(True) if stratum is None else F.col(stratum).cast("string") == level, F.lit(value)
            ).otherwise(scale)
        return scale


def _sums(rows: DataFrame, beta: np.ndarray, log_scale: dict[str, float], p: int):
    """Log-likelihood, gradient and curvature sums of every stratum."""
    scale = F.lit(None).cast("double")
    for level, value in log_scale.items():
        scale = F.when(F.col("stratum") == level, F.lit(float(np.exp(value)))).otherwise(scale)
    location = F.lit(float(beta[0]))
    for i in range(1, p):
        location = location + F.col(f"x{i}") * float(beta[i])
    z = (F.col("log_time") - location) / F.col("s")
    base = rows.withColumn("s", scale).withColumn("z", z).withColumn("e", F.exp("z"))
    d, zc, e, s = F.col("event"), F.col("z"), F.col("e"), F.col("s")
    x = [F.lit(1.0), *[F.col(f"x{i}") for i in range(1, p)]]
    aggregates = {
        "n": F.count("*"),
        "ll": F.sum(d * (zc - F.log(s)) - e),
        "gs": F.sum((e - d) * zc - d),
        "hs": F.sum(d * zc - zc * e - zc * zc * e),
    }
    for i in range(p):
        aggregates[f"g{i}"] = F.sum((e - d) * x[i] / s)
        aggregates[f"c{i}"] = F.sum((d - e - zc * e) * x[i] / s)
        for j in range(i, p):
            aggregates[f"h{i}_{j}"] = F.sum(-e * x[i] * x[j] / (s * s))
    return base.groupBy("stratum").agg(*[v.alias(k) for k, v in aggregates.items()]).collect()


def fit_survival(
    df: DataFrame, time: str, event: str, predictors: list[str], strata: str | None = None
) -> SurvivalFit:
    """Fit log time = x'b + scale * error on rows with a positive time."""
    stratum = F.lit("all") if strata is None else F.col(strata).cast("string")
    rows = df.select(
        F.log(F.col(time).cast("double")).alias("log_time"),
        F.col(event).cast("double").alias("event"),
        stratum.alias("stratum"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(predictors, start=1)],
    ).dropna().persist()
    p = len(predictors) + 1
    try:
        # centred and scaled predictors keep the curvature well conditioned
        first = rows.groupBy("stratum").agg(F.avg("log_time").alias("m")).limit(_MAX_STRATA + 1).collect()
        if len(first) > _MAX_STRATA:
            raise ValueError(f"more than {_MAX_STRATA} strata")
        levels = sorted(r["stratum"] for r in first)
        moments = rows.agg(
            F.avg("log_time").alias("m"),
            F.stddev_samp("log_time").alias("s"),
            *[F.avg(f"x{i}").alias(f"m{i}") for i in range(1, p)],
            *[F.stddev_samp(f"x{i}").alias(f"s{i}") for i in range(1, p)],
        ).first()
        centre = [moments[f"m{i}"] for i in range(1, p)]
        spread = [moments[f"s{i}"] or 1.0 for i in range(1, p)]
        unit = rows.select(
            "log_time",
            "event",
            "stratum",
            *[((F.col(f"x{i}") - centre[i - 1]) / spread[i - 1]).alias(f"x{i}") for i in range(1, p)],
        )
        size = p + len(levels)
        at = np.zeros(size)
        at[0] = moments["m"] + 0.5
        at[p:] = np.log(max(moments["s"] or 1.0, 1e-3))
        value, gradient, curvature, n = _newton_terms(unit, at, levels, p)
        converged = False
        for iterations in range(_ITERATIONS):
            step = _ascent(gradient, curvature)
            gain = float(gradient @ step)
            if gain < _TOLERANCE:
                converged = True
                break
            factor = 1.0
            while True:
                tried = _newton_terms(unit, at + factor * step, levels, p)
                if tried[0] >= value - 1e-9 or factor < 1e-6:
                    break
                factor *= 0.5
            at = at + factor * step
            value, gradient, curvature, n = tried
        if not converged:
            warnings.warn(f"the survival fit has not converged in {iterations + 1} steps", stacklevel=2)
        cov = np.linalg.inv(-curvature)
    finally:
        rows.unpersist()
    # back to the scale of the raw predictors
    back = np.eye(p)
    for i in range(1, p):
        back[i, i] = 1.0 / spread[i - 1]
        back[0, i] = -centre[i - 1] / spread[i - 1]
    estimate = back @ at[:p]
    error = np.sqrt(np.diag(back @ cov[:p, :p] @ back.T))
    scale = {level: float(np.exp(at[p + i])) for i, level in enumerate(levels)}
    return SurvivalFit((INTERCEPT, *predictors), estimate, error, scale, float(value), int(n), iterations + 1, converged)


def _newton_terms(rows: DataFrame, at: np.ndarray, levels: list[str], p: int):
    size = p + len(levels)
    gradient, curvature = np.zeros(size), np.zeros((size, size))
    value, n = 0.0, 0
    for row in _sums(rows, at[:p], dict(zip(levels, at[p:])), p):
        k = p + levels.index(row["stratum"])
        value += row["ll"]
        n += row["n"]
        gradient[k] += row["gs"]
        curvature[k, k] += row["hs"]
        for i in range(p):
            gradient[i] += row[f"g{i}"]
            curvature[i, k] += row[f"c{i}"]
            curvature[k, i] += row[f"c{i}"]
            for j in range(i, p):
                curvature[i, j] += row[f"h{i}_{j}"]
                if i != j:
                    curvature[j, i] += row[f"h{i}_{j}"]
    return value, gradient, curvature, n


def _ascent(gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """Newton step, with the curvature made negative definite if it is not."""
    values, vectors = np.linalg.eigh(-curvature)
    floor = max(values.max() * 1e-10, 1e-10)
    return vectors @ ((vectors.T @ gradient) / np.maximum(np.abs(values), floor))
