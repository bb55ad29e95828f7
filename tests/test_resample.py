"""Splits and resamples: sizes, partition invariance, exact slices."""

import pytest
from pyspark.sql import functions as F

from foldspark.operators.resample import (
    bootstraps,
    initial_split,
    mc_cv,
    rolling_origin,
    testing as held_out,
    training,
    validation_split,
    vfold_cv,
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1003).select(
        F.col("id").alias("key"), (F.col("id") * 37 % 501).cast("double").alias("y"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), (F.col("id") % 40).cast("string"))).alias("level"),
    )


def _keys(df):
    return sorted(r["key"] for r in df.select("key").collect())


def test_split_sizes_and_partition(rows):
    split = initial_split(rows, "key", 0.8, seed=501)
    train, test = _keys(training(split)), _keys(held_out(split))
    assert len(train) == 802 and not set(train) & set(test) and len(train) + len(test) == 1003


def test_split_does_not_depend_on_layout(rows):
    a = _keys(training(initial_split(rows.repartition(1), "key", 0.8, strata="y", seed=9)))
    b = _keys(training(initial_split(rows.repartition(8), "key", 0.8, strata="y", seed=9)))
    assert a == b
    assert a != _keys(training(initial_split(rows, "key", 0.8, strata="y", seed=10)))


def test_strata_have_similar_quartiles(rows):
    split = initial_split(rows, "key", 0.8, strata="y", seed=1)
    for side in (training(split), held_out(split)):
        middle = side.agg(F.percentile("y", 0.5)).first()[0]
        assert middle == pytest.approx(250, abs=25)


def test_text_strata_pool_small_levels(rows):
    split = initial_split(rows, "key", 0.5, strata="level", seed=1)
    hot = training(split).where("level = 'hot'").count()
    total = rows.where("level = 'hot'").count()
    assert hot == total // 2


def test_folds_partition_the_rows(rows):
    folds = vfold_cv(rows, "key", 10, seed=3)
    sizes = {i: folds.assessment(i).count() for i in folds.ids}
    assert sorted(sizes.values()) == [100] * 7 + [101] * 3
    assert sorted(k for i in folds.ids for k in _keys(folds.assessment(i))) == list(range(1003))
    assert not set(_keys(folds.analysis("Fold01"))) & set(_keys(folds.assessment("Fold01")))


def test_repeats_differ_and_ids_agree(rows):
    folds = vfold_cv(rows, "key", 5, repeats=2, seed=3)
    assert len(folds.ids) == 10
    long = folds.membership().where("role = 'assessment'").select("row", "id")
    short = folds.assessment_membership().select("row", "id")
    assert long.exceptAll(short).count() == 0 and short.exceptAll(long).count() == 0
    assert _keys(folds.assessment("Repeat1_Fold01")) != _keys(folds.assessment("Repeat2_Fold01"))


def test_monte_carlo_and_validation(rows):
    sizes = {(r["id"], r["role"]): r["n"] for r in mc_cv(rows, "key", 0.9, times=3, seed=4).sizes().collect()}
    assert all(n == (902 if role == "analysis" else 101) for (_, role), n in sizes.items())
    sizes = {r["role"]: r["n"] for r in validation_split(rows, "key", 0.75, seed=4).sizes().collect()}
    assert sizes == {"analysis": 752, "assessment": 251}


def test_bootstrap_draws_n_rows(rows):
    sets = bootstraps(rows, "key", times=3, seed=4)
    for i in sets.ids:
        drawn = _keys(sets.analysis(i))
        assert len(drawn) == 1003
        assert set(drawn) | set(_keys(sets.assessment(i))) == set(range(1003))
        assert not set(drawn) & set(_keys(sets.assessment(i)))


def test_rolling_origin_slices(spark):
    year = spark.range(1, 366).withColumnRenamed("id", "x")
    got = {
        (r["slice"], r["role"]): (r["a"], r["b"])
        for r in rolling_origin(year, "x", initial=180, assess=30, skip=29)
        .groupBy("slice", "role").agg(F.min("x").alias("a"), F.max("x").alias("b")).collect()
    }
    want = {}
    for k in range(6):
        want[k + 1, "analysis"] = (1 + 30 * k, 180 + 30 * k)
        want[k + 1, "assessment"] = (181 + 30 * k, 210 + 30 * k)
    assert got == want
