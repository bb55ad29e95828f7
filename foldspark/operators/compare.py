"""Comparing models over shared resamples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foldspark.functions.hashing import hash_index


def metric_matrix(per_resample: DataFrame, metric: str, workflows: list[str]) -> DataFrame:
    """One row per resample, one column per workflow."""
    kept = per_resample.where(F.col("metric") == metric)
    return kept.groupBy("id").pivot("wflow_id", workflows).agg(F.first("estimate"))


def differences(matrix: DataFrame, a: str, b: str) -> DataFrame:
    return matrix.withColumn("difference", F.col(a) - F.col(b))


def bootstrap_draws(
    per_resample: DataFrame, metric: str, draws: int, resamples: int, seed: int = 0
) -> DataFrame:
    """(draw, model, posterior): mean metric of resamples drawn with replacement.

    All models share the resamples of a draw, so their contrast stays paired. The
    metric table has one row per workflow and resample; the resamples are numbered
    in the order of their (repeat and) id, so any ids will do.
    """
    spark = per_resample.sparkSession
    kept = per_resample.where(F.col("metric") == metric)
    names = ["repeat", "id"] if "repeat" in kept.columns else ["id"]
    # as many rows as resamples
    numbered = kept.select(*names).distinct()
    numbered = numbered.withColumn("pick", F.row_number().over(Window.orderBy(*names)).cast("long") - 1)
    found = numbered.count()
    if found != resamples:
        raise ValueError(f"the metrics have {found} resamples, not {resamples}")
    picks = spark.range(1, draws + 1).select(
        F.col("id").alias("draw"), F.explode(F.sequence(F.lit(1), F.lit(resamples))).alias("slot")
    ).withColumn("pick", hash_index(resamples, seed, "draw", "slot"))
    kept = kept.join(numbered, names).select(F.col("wflow_id").alias("model"), "pick", "estimate")
    return (
        picks.join(kept, "pick")
        .groupBy("draw", "model")
        .agg(F.avg("estimate").alias("posterior"))
    )


def contrast_models(draws: DataFrame, a: str, b: str) -> DataFrame:
    """Difference of two models within every draw: one aggregation, no self-join."""
    first = F.max(F.when(F.col("model") == a, F.col("posterior")))
    second = F.max(F.when(F.col("model") == b, F.col("posterior")))
    return (
        draws.where(F.col("model").isin(a, b))
        .groupBy("draw")
        .agg((first - second).alias("difference"))
        .withColumn("contrast", F.lit(f"{a} vs {b}"))
    )


def summarize_contrast(contrasts: DataFrame, size: float = 0.0) -> DataFrame:
    """Mean difference, P(difference > 0), 90 % interval and practical equivalence.

    The draws table has a fixed number of rows, so the exact percentile is small.
    """
    d = F.col("difference")

    def share(condition: Column) -> Column:
        return F.avg(condition.cast("double"))

    return contrasts.groupBy("contrast").agg(
        share(d > 0).alias("probability"),
        F.avg(d).alias("mean"),
        F.percentile(d, 0.05).alias("lower"),
        F.percentile(d, 0.95).alias("upper"),
        F.lit(float(size)).alias("size"),
        share(d < -size).alias("pract_neg"),
        share((d >= -size) & (d <= size)).alias("pract_equiv"),
        share(d > size).alias("pract_pos"),
    )
