"""Correlation tests and paired comparisons from one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foldspark.functions.distributions import normal_quantile, t_two_sided_udf

_NAMES = ("n", "estimate", "statistic", "df", "conf_low", "conf_high")


def pair_stats(a: Column, b: Column) -> Column:
    """Complete pairs and their correlation, as one struct of aggregates."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    spread = F.sqrt(F.var_pop(x) * F.var_pop(y))
    r = F.when(spread > 0, F.try_divide(F.covar_pop(x, y), spread))
    # greatest and least skip missing values, so the bound must not see one
    bounded = F.when(r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
    return F.struct(F.count(x).alias("n"), bounded.alias("r"))


def _test(n: Column, r: Column, level: float) -> list[Column]:
    df = n - 2
    t = r * F.sqrt(F.try_divide(df.cast("double"), 1.0 - r * r))
    half = normal_quantile(0.5 + level / 2.0) / F.sqrt(F.when(n > 3, (n - 3).cast("double")))
    inside = F.when(F.abs(r) < 1, r)
    middle = F.atanh(inside)
    return [
        n.alias("n"),
        r.alias("estimate"),
        t.alias("statistic"),
        df.alias("df"),
        F.tanh(middle - half).alias("conf_low"),
        F.tanh(middle + half).alias("conf_high"),
    ]


def correlation_tests(
    df: DataFrame, y: str, xs: list[str], level: float = 0.95, by: list[str] | None = None
) -> DataFrame:
    """Pearson correlation of y with every predictor, one pass over the rows."""
    by = by or []
    wide = df.groupBy(*by).agg(
        *[pair_stats(F.col(x), F.col(y)).alias(f"s{i}") for i, x in enumerate(xs)]
    )
    entries = [
        F.struct(F.lit(x).alias("predictor"), F.col(f"s{i}.n").alias("n"), F.col(f"s{i}.r").alias("r"))
        for i, x in enumerate(xs)
    ]
    long = wide.select(*by, F.explode(F.array(*entries)).alias("e"))
    return long.select(*by, "e.predictor", *_test(F.col("e.n"), F.col("e.r"), level))


def with_p_value(tests: DataFrame) -> DataFrame:
    return tests.withColumn(
        "p_value", t_two_sided_udf(F.col("statistic"), F.col("df").cast("double"))
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Wide matrix (term, one column per variable) with a NULL diagonal."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]
    wide = df.agg(
        *[pair_stats(F.col(columns[i]), F.col(columns[j])).alias(f"s_{i}_{j}") for i, j in pairs]
    )

    def cell(i: int, j: int) -> Column:
        if i == j:
            return F.lit(None).cast("double")
        return F.col(f"s_{min(i, j)}_{max(i, j)}.r")

    rows = [
        F.struct(
            F.lit(name).alias("term"),
            *[cell(i, j).alias(other) for j, other in enumerate(columns)],
        )
        for i, name in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def mean_inference(df: DataFrame, value: Column, t_quantile_of, level: float = 0.95) -> DataFrame:
    """The intercept-only model: mean, standard error, t, p and interval.

    ``t_quantile_of(p, df)`` supplies the quantile once the size is known.
    """
    sums = df.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("estimate"),
        F.try_divide(F.stddev_samp(value), F.sqrt(F.count(value))).alias("std_error"),
    )
    # one row, aggregated once
    found = sums.first()
    n = found["n"]
    sums = df.sparkSession.createDataFrame([tuple(found)], "n long, estimate double, std_error double")
    half = t_quantile_of(0.5 + level / 2.0, n - 1) * F.col("std_error") if n > 1 else F.lit(None)
    tidy = sums.select(
        "n",
        "estimate",
        "std_error",
        F.try_divide("estimate", "std_error").alias("statistic"),
        (F.col("n") - 1).alias("df"),
        (F.col("estimate") - half).alias("conf_low"),
        (F.col("estimate") + half).alias("conf_high"),
    )
    return with_p_value(tidy)


def paired_t_test(df: DataFrame, a: str, b: str, t_quantile_of, level: float = 0.95) -> DataFrame:
    """The paired test is the intercept-only model of the differences."""
    return mean_inference(df, F.col(a) - F.col(b), t_quantile_of, level)
