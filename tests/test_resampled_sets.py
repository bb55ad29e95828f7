"""Sets of resampled fits: rows computed once, codes and splines that cross to Python as numbers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldspark.operators.gram import Coding, Member, grams
from foldspark.operators.models import decision_tree, linear_reg, rand_forest
from foldspark.operators.recipe import Other, Recipe
from foldspark.operators.resample import vfold_cv
from foldspark.operators.splines import NaturalSpline
from foldspark.plans.workflow import Workflow, fit_resamples, workflow_set

def test_rows_are_computed_once_for_all_fits_and_scores(spark):
    computed = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def slow(i):
        computed.add(1)
        return float(i % 7)

    rows = spark.range(400).select("id", slow("id").alias("x"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"))
    rows = rows.withColumn("y", F.col("id") % 5 + F.col("id") / 400.0)
    folds = vfold_cv(rows, "id", 5, seed=3)
    members = {
        "lm": Workflow(Recipe.of(rows, "y", ["x", "g"]).step_dummy("g"), linear_reg()),
        "rf": Workflow(Recipe.of(rows, "y", ["x", "g"]), rand_forest(trees=2, max_depth=3)),
    }
    assert fit_resamples(members, folds).collect_metrics().count() == 6
    assert computed.value <= 2 * 400


def test_resampled_trees_equal_trees_fitted_one_by_one(spark):
    rows = [(i, float(i % 11), None if i % 29 == 0 else "abc"[i % 3] if i != 17 else "rare", None if i % 31 == 0 else float(i % 4)) for i in range(300)]
    table = spark.createDataFrame([(*r, r[1] * 2 + (r[2] == "b") * 3 + (r[3] or 0) ** 2) for r in rows], "id long, x double, g string, z double, y double")
    folds = vfold_cv(table, "id", 4, seed=8)
    plain = Recipe.of(table, "y", ["g", "x", "z"])
    pooled = plain.step_other("g", threshold=0.1)
    bent = Recipe.of(table, "y", ["x", "g"]).step_ns("x", deg_free=2)
    spec = decision_tree(min_n=2, max_depth=5)
    members = {n: Workflow(r, spec) for n, r in {"plain": plain, "pooled": pooled, "bent": bent}.items()}
    got = {(r["wflow_id"], r["row"]): (r["id"], r["pred"]) for r in fit_resamples(members, folds).predictions.collect()}
    assert len(got) == 900
    for n, w in members.items():
        for i in folds.ids:
            for r in w.fit(folds.analysis(i)).predict(folds.assessment(i)).collect():
                fold, pred = got[n, r["id"]]
                assert fold == i
                assert pred is None if r["pred"] is None else pred == pytest.approx(r["pred"])


def test_recipes_that_begin_alike_are_estimated_together(spark, monkeypatch):
    rows = spark.createDataFrame([(i, float(i % 13), "abcd"[i % 4], float(i % 7)) for i in range(200)], "id long, x double, g string, y double")
    folds = vfold_cv(rows, "id", 3, seed=2)
    first = Recipe.of(rows, "y", ["x", "g"]).step_other("g", threshold=0.1)
    more = first.step_dummy("g").step_ns("x", deg_free=3)
    asked, kept = [], Other._kept
    monkeypatch.setattr(Other, "_kept", lambda self, *a: asked.append(1) or kept(self, *a))
    both = workflow_set({"short": first.step_dummy("g"), "long": more}, {"lm": linear_reg()})
    found = fit_resamples(both, folds)
    assert len(asked) == 1
    for n, recipe in {"short_lm": first.step_dummy("g"), "long_lm": more}.items():
        alone = fit_resamples(Workflow(recipe, linear_reg()), folds)
        np.testing.assert_allclose(found.fits[n, "Fold02"].estimate, alone.fits["workflow", "Fold02"].estimate, rtol=1e-9)


# ---------------------------------------------------------------- codes and splines that cross as numbers

def test_products_of_codes_and_splines_equal_dense_ones(spark):
    rng = np.random.default_rng(4)
    n = 500
    code, far = rng.integers(0, 4, n).astype(float), rng.integers(0, 3, n).astype(float)
    x, u, v = rng.uniform(0, 1, n), rng.normal(size=n) + 50, rng.uniform(-1, 2, n)
    code[3], far[4], x[5], u[6], code[7] = np.nan, np.nan, np.inf, np.nan, 9.0
    times = rng.integers(0, 4, n)
    spline, other = NaturalSpline([0.1, 0.3, 0.6, 0.9]), NaturalSpline([-0.5, 0.0, 1.0])
    rows = spark.createDataFrame(
        [tuple(None if np.isnan(e) else float(e) for e in r) + (int(t),) for r, t in zip(np.column_stack([code, far, x, u, v]), times)],
        "code double, far double, x double, u double, v double, times int",
    ).repartition(3)
    vector = F.array("code", "u", "code", "u", "far", "x", "v", "x")
    codes = (Coding(0, 4, None, 0), Coding(2, 4, 3, 0), Coding(4, 3, None, 4))
    weights = {"all": F.lit(1), "some": F.col("times")}
    curves = {s: ((5, spline), (6, other)) for s in weights}
    found = grams(rows, weights, {"m": Member(vector, 8, ("all", "some"), curves, codes), "flat": Member(vector, 8, ("some",), None, codes)})
    known = np.isfinite(np.column_stack([code, far, x, u, v])).all(axis=1) & (code < 4)
    one, two = np.eye(4)[code[known].astype(int)], np.eye(3)[far[known].astype(int)]
    # plain columns keep their places, bent ones follow, a factor is no column of its own
    plain = np.hstack([one, u[known, None], one * u[known, None], two])
    dense = np.hstack([plain, x[known, None], spline.values(x[known]), other.values(v[known])])
    flat = np.hstack([plain, x[known, None], v[known, None], x[known, None]])
    for (name, subset), table, w in [
        (("m", "all"), dense, np.ones(known.sum())), (("m", "some"), dense, times[known]), (("flat", "some"), flat, times[known])
    ]:
        got, mean = found[name, subset], (table * w[:, None]).sum(axis=0) / w.sum()
        assert got.n == w.sum()
        np.testing.assert_allclose(got.mean, mean, rtol=1e-9, atol=1e-12)
        gap = table - mean
        np.testing.assert_allclose(got.cross, (gap * w[:, None]).T @ gap, rtol=1e-7, atol=1e-7)


def test_a_spline_is_scored_by_one_cubic(spark):
    spline = NaturalSpline([0.0, 0.2, 0.5, 0.7, 1.0])
    own = np.array([0.4, -1.0, 2.0, 0.7])
    points = [-0.4, 0.0, 0.1, 0.2, 0.33, 0.7, 1.0, 1.8]
    rows = spark.createDataFrame([(p,) for p in points] + [(None,)], "x double")
    got = [r["s"] for r in rows.select("x", spline.score(F.col("x"), own).alias("s")).orderBy("x").collect()]
    assert got[0] is None
    np.testing.assert_allclose(got[1:], spline.values(np.array(points)) @ own, rtol=1e-9, atol=1e-12)
