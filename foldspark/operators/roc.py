"""Exact ROC curves and areas.

Rows are counted per distinct score first, so ties (even a score shared by a third
of the rows) become one row. Cumulative counts come from bucketed running totals:
no single task sees the whole score range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foldspark.operators.ordered import running_totals


def score_counts(
    df: DataFrame, event: Column, score: Column, by: list[str] | None = None
) -> DataFrame:
    """(by, score, pos, neg): events and non-events per distinct score."""
    by = by or []
    hit = event.cast("long")
    narrow = df.select(*by, score.cast("double").alias("score"), hit.alias("hit"))
    return (
        narrow.where(F.col("score").isNotNull() & F.col("hit").isNotNull())
        .groupBy(*by, "score")
        .agg(F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg"))
    )


def roc_curve(df: DataFrame, event: Column, score: Column, by: list[str] | None = None) -> DataFrame:
    """(by, threshold, specificity, sensitivity) in the order of the threshold.

    A row is called an event when its score is at least the threshold. The open
    ends of the curve have a NULL threshold: ``end`` is ``-Inf`` or ``+Inf`` there
    and NULL on ordinary points.
    """
    by = by or []
    counts = score_counts(df, event, score, by)
    ranked = running_totals(counts, "score", ["pos", "neg"], by)
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    joined = _with_totals(ranked, totals, by)
    points = joined.select(
        *by,
        F.lit(None).cast("string").alias("end"),
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_neg") - F.col("neg"), "N").alias("specificity"),
        F.try_divide(F.col("P") - F.col("cum_pos") + F.col("pos"), "P").alias("sensitivity"),
    )
    ends = totals.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.lit("-Inf").alias("end"), F.lit(0.0).alias("sp"), F.lit(1.0).alias("se")),
                F.struct(F.lit("+Inf").alias("end"), F.lit(1.0).alias("sp"), F.lit(0.0).alias("se")),
            )
        ).alias("e"),
    ).select(
        *by,
        "e.end",
        F.lit(None).cast("double").alias("threshold"),
        F.col("e.sp").alias("specificity"),
        F.col("e.se").alias("sensitivity"),
    )
    return points.unionByName(ends)


def roc_auc(df: DataFrame, event: Column, score: Column, by: list[str] | None = None) -> DataFrame:
    """Area under the curve, ties counted half: (by, estimate)."""
    by = by or []
    ranked = running_totals(score_counts(df, event, score, by), "score", ["pos", "neg"], by)
    wins = F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") / 2.0)
    sums = ranked.groupBy(*by).agg(
        F.sum(wins).alias("wins"),
        F.sum("pos").cast("double").alias("P"),
        F.sum("neg").cast("double").alias("N"),
    )
    return sums.select(*by, F.try_divide("wins", F.col("P") * F.col("N")).alias("estimate"))


def _with_totals(ranked: DataFrame, totals: DataFrame, by: list[str]) -> DataFrame:
    if not by:
        row = totals.first()
        return ranked.withColumns({"P": F.lit(row["P"]), "N": F.lit(row["N"])})
    renamed = totals.select(*[F.col(b).alias(f"__t_{b}") for b in by], "P", "N")
    condition = None
    for b in by:
        same = F.col(b).eqNullSafe(F.col(f"__t_{b}"))
        condition = same if condition is None else condition & same
    return ranked.join(renamed, condition).drop(*[f"__t_{b}" for b in by])


# ---------------------------------------------------------------- several classes

def per_class_scores(
    df: DataFrame, truth: str, scores: dict[str, str], by: list[str] | None = None
) -> DataFrame:
    """One row per class score: (by, level, truth, score). ``scores`` maps level to column."""
    entries = [
        F.struct(F.lit(level).alias("level"), F.col(column).cast("double").alias("score"))
        for level, column in scores.items()
    ]
    return df.select(
        *(by or []),
        F.col(truth).cast("string").alias("truth"),
        F.explode(F.array(*entries)).alias("s"),
    ).select(*(by or []), "truth", "s.level", "s.score")


def roc_curve_one_vs_all(
    df: DataFrame, truth: str, scores: dict[str, str], by: list[str] | None = None
) -> DataFrame:
    long = per_class_scores(df, truth, scores, by)
    return roc_curve(long, F.col("truth") == F.col("level"), F.col("score"), [*(by or []), "level"])


def roc_auc_weighted(df: DataFrame, truth: str, scores: dict[str, str]) -> DataFrame:
    """One-versus-all areas averaged with the class shares as weights."""
    long = per_class_scores(df, truth, scores)
    counts = score_counts(long, F.col("truth") == F.col("level"), F.col("score"), ["level"])
    ranked = running_totals(counts, "score", ["pos", "neg"], ["level"])
    wins = F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") / 2.0)
    areas = ranked.groupBy("level").agg(
        F.sum(wins).alias("wins"),
        F.sum("pos").cast("double").alias("P"),
        F.sum("neg").cast("double").alias("N"),
    )
    area = F.try_divide("wins", F.col("P") * F.col("N"))
    return areas.agg(F.try_divide(F.sum(area * F.col("P")), F.sum("P")).alias("estimate"))


def roc_auc_pairwise(df: DataFrame, truth: str, scores: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Mean over all pairs of classes of the two areas that separate them.

    For the score of class j, every distinct value carries one count per true
    class. One set of running totals then gives the area of j against each other
    class, so no pair of rows is ever formed.
    """
    by = by or []
    levels = list(scores)
    long = per_class_scores(df, truth, scores, by).where(F.col("score").isNotNull())
    columns = [f"n{i}" for i in range(len(levels))]
    counts = long.groupBy(*by, "level", "score").agg(
        *[F.sum((F.col("truth") == v).cast("long")).alias(c) for v, c in zip(levels, columns)]
    )
    ranked = running_totals(counts, "score", columns, [*by, "level"])
    own = F.coalesce(
        *[F.when(F.col("level") == v, F.col(c)) for v, c in zip(levels, columns)]
    ).cast("double")
    sums = ranked.groupBy(*by, "level").agg(
        *[F.sum(own * (F.col(f"cum_{c}") - F.col(c) / 2.0)).alias(f"wins_{c}") for c in columns],
        *[F.sum(c).cast("double").alias(f"size_{c}") for c in columns],
    )
    own_size = F.coalesce(
        *[F.when(F.col("level") == v, F.col(f"size_{c}")) for v, c in zip(levels, columns)]
    )
    others = F.array(
        *[
            F.when(
                F.col("level") != v,
                F.try_divide(F.col(f"wins_{c}"), own_size * F.col(f"size_{c}")),
            )
            for v, c in zip(levels, columns)
        ]
    )
    return sums.select(*by, F.explode(others).alias("a")).groupBy(*by).agg(F.avg("a").alias("estimate"))
