"""Classifiers, mixed and survival models over several resamples at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldspark.operators import logistic, partials
from foldspark.operators.logistic import ClassMember, fit_logistic_set
from foldspark.operators.mixed import fit_mixed, fit_mixed_set
from foldspark.operators.models import linear_reg, logistic_reg, mixed_reg, multinom_reg, survival_reg
from foldspark.operators.recipe import Recipe
from foldspark.operators.resample import vfold_cv
from foldspark.plans.workflow import Workflow, fit_resamples, workflow_set


@pytest.fixture(scope="module")
def plants(spark):
    rng = np.random.default_rng(2)
    n = 900
    x, z = rng.normal(size=(2, n))
    site = rng.choice(["a", "b", "c"], n)
    score = 0.8 * x - 0.5 * z + (site == "b") + rng.logistic(size=n)
    kind = np.where(score > 0.7, "tall", np.where(score > -0.7, "mid", "low"))
    rows = [(i, float(x[i]), float(z[i]), str(site[i]), str(kind[i]), "yes" if score[i] > 0 else "no") for i in range(n)]
    rows += [(n, None, 1.0, "a", "low", "no"), (n + 1, 0.5, 1.0, "a", None, None)]
    return spark.createDataFrame(rows, "id long, x double, z double, site string, kind string, tall string").repartition(6).persist()


def _newton(x, y, classes):
    """Plain multinomial fit, dense."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros((classes - 1, x.shape[1]))
    for _ in range(30):
        e = np.exp(np.hstack([np.zeros((len(x), 1)), x @ beta.T]))
        p = (e / e.sum(axis=1, keepdims=True))[:, 1:]
        hit = (y[:, None] == np.arange(1, classes)).astype(float)
        gradient = ((hit - p).T @ x).ravel()
        size = beta.size
        h = np.zeros((size, size))
        k = x.shape[1]
        for a in range(classes - 1):
            for b in range(classes - 1):
                w = p[:, a] * ((a == b) - p[:, b])
                h[a * k : (a + 1) * k, b * k : (b + 1) * k] = (x * w[:, None]).T @ x
        beta += np.linalg.solve(h, gradient).reshape(beta.shape)
    return beta


@pytest.mark.parametrize("held", [partials.HELD, 200])
def test_all_fits_in_common_passes_equal_dense_ones(plants, monkeypatch, held):
    # a small bound gives several waves and several levels of sums
    monkeypatch.setattr(partials, "HELD", held)
    monkeypatch.setattr(logistic, "HELD", held)
    label = F.when(F.col("kind") == "low", 0).when(F.col("kind") == "mid", 1).when(F.col("kind") == "tall", 2)
    weights = {"all": F.lit(1), "even": (F.col("id") % 2 == 0).cast("int"), "twice": (F.col("id") % 3).cast("int")}
    turn = np.array([[1.0, 1.0], [0.0, 2.0]])
    members = {
        "plain": ClassMember(F.array("x", "z"), 2, label, 3, weights),
        "turned": ClassMember(F.array("x", "z"), 2, label, 3, {"even": weights["even"]}, {"even": turn}),
        "two": ClassMember(F.array("x"), 1, F.when(F.col("tall") == "no", 0).when(F.col("tall") == "yes", 1), 2, weights),
    }
    found = fit_logistic_set(plants, members)
    data = plants.toPandas().dropna()
    kinds = data["kind"].map({"low": 0, "mid": 1, "tall": 2}).to_numpy()
    x = data[["x", "z"]].to_numpy()
    times = {"all": np.ones(len(data), int), "even": (data["id"] % 2 == 0).astype(int), "twice": (data["id"] % 3).astype(int)}
    for name, t in times.items():
        rows = np.repeat(np.arange(len(data)), t)
        np.testing.assert_allclose(found["plain", name].beta, _newton(x[rows], kinds[rows], 3), rtol=1e-5, atol=1e-6)
        tall = (data["tall"] == "yes").astype(int).to_numpy()
        np.testing.assert_allclose(found["two", name].beta, _newton(x[rows][:, :1], tall[rows], 2), rtol=1e-5, atol=1e-6)
    rows = np.flatnonzero(times["even"])
    np.testing.assert_allclose(found["turned", "even"].beta, _newton(x[rows] @ turn, kinds[rows], 3), rtol=1e-5, atol=1e-6)
    assert all(f.converged and f.iterations < 12 for f in found.values())


def test_a_curvature_too_large_is_refused(plants, monkeypatch):
    monkeypatch.setattr(logistic, "MAX_COEFFICIENTS", 3)
    with pytest.raises(ValueError, match="coefficients"):
        fit_logistic_set(plants, {"m": ClassMember(F.array("x", "z"), 2, F.lit(0), 3, {"all": F.lit(1)})})


def test_resampled_classes_equal_fits_one_by_one(plants):
    folds = vfold_cv(plants, "id", 4, seed=5)
    recipe = Recipe.of(plants, "kind", ["x", "z", "site"]).step_other("site", threshold=0.2).step_dummy("site")
    bent = Recipe.of(plants, "kind", ["x", "z"]).step_ns("x", deg_free=3)
    found = fit_resamples(workflow_set({"sites": recipe, "bent": bent}, {"glm": multinom_reg()}), folds)
    assert found.levels == ("low", "mid", "tall")
    one = Workflow(recipe, multinom_reg()).fit(folds.analysis("Fold02"))
    np.testing.assert_allclose(found.fits["sites_glm", "Fold02"].coefficients, one.model.coefficients, rtol=1e-6, atol=1e-8)
    curve = Workflow(bent, multinom_reg()).fit(folds.analysis("Fold03"))
    np.testing.assert_allclose(found.fits["bent_glm", "Fold03"].coefficients, curve.model.coefficients, rtol=1e-5, atol=1e-6)
    want = {r["id"]: r for r in one.predict(one.predict(folds.assessment("Fold02"), "class"), "prob").collect()}
    got = found.predictions.where("wflow_id = 'sites_glm' and id = 'Fold02'").collect()
    assert len(got) == len(want)
    for r in got:
        assert r["pred_class"] == want[r["row"]]["pred_class"]
        assert r["pred_mid"] == pytest.approx(want[r["row"]]["pred_mid"])
    table = {(r["wflow_id"], r["metric"]): r["mean"] for r in found.collect_metrics().collect()}
    assert set(table) == {(w, m) for w in ("sites_glm", "bent_glm") for m in ("accuracy", "mcc", "roc_auc")}
    assert 0.55 < table["sites_glm", "roc_auc"] < 0.95
    assert found.parameters(plants.sparkSession).count() == 4 * 2 * (5 + 5)


def test_modes_are_not_mixed(plants):
    folds = vfold_cv(plants, "id", 3)
    classes = Workflow(Recipe.of(plants, "tall", ["x"]), logistic_reg())
    numbers = Workflow(Recipe.of(plants, "z", ["x"]), linear_reg())
    with pytest.raises(ValueError, match="modes"):
        fit_resamples({"a": classes, "b": numbers}, folds)
    with pytest.raises(ValueError, match="two levels"):
        fit_resamples(Workflow(Recipe.of(plants, "kind", ["x"]), logistic_reg()), folds)


# ---------------------------------------------------------------- mixed models

def _balanced(seed=1, groups=12, m=5, offset=0.0):
    rng = np.random.default_rng(seed)
    x = np.arange(m) + offset
    b = rng.multivariate_normal([0, 0], [[1.0, 0.3], [0.3, 0.5]], groups)
    y = 2 + b[:, :1] + (0.7 + b[:, 1:]) * (x - offset) + 0.4 * rng.normal(size=(groups, m))
    return x, y


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_random_slopes_of_a_balanced_design(spark, offset):
    """With the same design in every group, the fit follows from the groups' own lines; an offset costs no digits."""
    x, y = _balanced(offset=offset)
    z = np.column_stack([np.ones(len(x)), x - offset])
    lines = np.linalg.lstsq(z, y.T, rcond=None)[0].T
    sigma2 = ((y - lines @ z.T) ** 2).sum() / (len(y) * (len(x) - 2))
    between = np.cov(lines.T)
    rows = spark.createDataFrame(
        [(f"g{i}", float(x[j]), float(y[i, j]) + offset) for i in range(len(y)) for j in range(len(x))], "g string, x double, y double"
    )
    fit = fit_mixed(Recipe.of(rows, "y", ["x"]).prep(rows), rows, "g", "x")
    assert fit.converged and fit.iterations < 15
    assert fit.sigma2 == pytest.approx(sigma2, rel=1e-4)
    assert fit.fixed[1] == pytest.approx(lines[:, 1].mean(), rel=1e-6)
    assert fit.random_cov[1, 1] == pytest.approx((between - sigma2 * np.linalg.inv(z.T @ z))[1, 1], rel=1e-3)
    assert np.sqrt(fit.fixed_cov[1, 1]) == pytest.approx(np.sqrt(between[1, 1] / len(y)), rel=1e-3)
    if offset == 0:
        np.testing.assert_allclose(fit.random_cov, between - sigma2 * np.linalg.inv(z.T @ z), rtol=1e-3)


def test_mixed_workflow_predictions(spark):
    x, y = _balanced(3)
    rows = spark.createDataFrame(
        [(i * 10 + j, f"g{i}", float(x[j]), float(y[i, j])) for i in range(len(y)) for j in range(len(x))],
        "key long, g string, x double, y double",
    )
    flow = Workflow().with_model(mixed_reg(), group="g", slope="x").with_variables(rows, "y", ["g", "x"], fixed=["x"])
    fitted = flow.fit(rows)
    new = spark.createDataFrame([("g0", 1.0), ("new", 1.0), (None, 1.0), ("g0", None)], "g string, x double")
    pred = [r["pred"] for r in fitted.predict(new.coalesce(1).withColumn("i", F.monotonically_increasing_id())).orderBy("i").collect()]
    fixed = fitted.model.fit.fixed
    assert pred[1] == pred[2] == pytest.approx(fixed @ [1, 1]) and pred[3] is None
    # the group's own best prediction
    f = fitted.model.fit
    z = np.column_stack([np.ones(len(x)), x])
    v = z @ f.random_cov @ z.T + f.sigma2 * np.eye(len(x))
    b = f.random_cov @ z.T @ np.linalg.solve(v, y[0] - z @ fixed)
    assert pred[0] == pytest.approx([1, 1] @ (fixed + b), rel=1e-6)
    assert fitted.predict(new, "population").where("g = 'g0' and x = 1").first()["pred"] == pytest.approx(fixed @ [1, 1])


def test_mixed_resamples_equal_fits_one_by_one(spark):
    x, y = _balanced(4, groups=20, m=8)
    rows = spark.createDataFrame(
        [(i * 10 + j, f"g{i}", float(x[j]), float(y[i, j])) for i in range(len(y)) for j in range(len(x))],
        "key long, g string, x double, y double",
    )
    folds = vfold_cv(rows, "key", 3, seed=9)
    flow = Workflow().with_model(mixed_reg(), group="g").with_variables(rows, "y", ["x"])
    found = fit_resamples({"mixed": flow, "line": Workflow(Recipe.of(rows, "y", ["x"]), linear_reg())}, folds)
    for i in folds.ids:
        alone = flow.fit(folds.analysis(i))
        assert found.fits["mixed", i].sigma2 == pytest.approx(alone.model.fit.sigma2, rel=1e-5)
        want = {r["key"]: r["pred"] for r in alone.predict(folds.assessment(i)).collect()}
        got = {r["row"]: r["pred"] for r in found.predictions.where((F.col("id") == i) & (F.col("wflow_id") == "mixed")).collect()}
        assert got == pytest.approx(want, rel=1e-5)
    metrics = {(r["wflow_id"], r["metric"]): r["mean"] for r in found.collect_metrics().collect()}
    assert metrics["mixed", "rmse"] < metrics["line", "rmse"]


def test_model_terms_are_checked(spark):
    with pytest.raises(ValueError, match="group"):
        Workflow().with_model(mixed_reg())
    with pytest.raises(ValueError, match="strata"):
        Workflow().with_model(linear_reg(), strata="k")


def test_no_rows_to_fit(spark):
    rows = spark.createDataFrame([], "g string, x double, y double")
    with pytest.raises(ValueError, match="no complete row"):
        fit_mixed_set(Recipe.of(rows, "y", ["x"]).prep(rows), rows, "g", None, {"all": F.lit(1)})


def test_survival_workflow(spark):
    rng = np.random.default_rng(8)
    n = 1500
    age, k = rng.uniform(0, 4, n), rng.choice(["p", "q"], n)
    life = np.exp(1 + 0.3 * age + np.where(k == "p", 0.5, 0.9) * np.log(rng.exponential(size=n)))
    cut = rng.uniform(0, 20, n)
    rows = [(i, float(age[i]), str(k[i]), float(min(life[i], cut[i])), int(life[i] <= cut[i])) for i in range(n)]
    rows = spark.createDataFrame(rows, "id long, age double, k string, t double, d int")
    flow = Workflow().with_model(survival_reg(), event="d", strata="k").with_variables(rows, "t", ["age", "k"])
    fitted = flow.fit(rows)
    assert fitted.model.fit.terms == ("(Intercept)", "age")
    assert fitted.model.fit.estimate == pytest.approx([1.0, 0.3], abs=0.12)
    new = spark.createDataFrame([(2.0, "p"), (2.0, "other")], "age double, k string")
    time, median = (fitted.predict(new, kind).collect() for kind in ("time", "median"))
    assert median[0]["pred"] == pytest.approx(time[0]["pred"] * np.log(2) ** fitted.model.fit.scale["p"])
    assert median[1]["pred"] is None and time[1]["pred"] == time[0]["pred"]
    found = fit_resamples(flow, vfold_cv(rows, "id", 3))
    assert {r["part"] for r in found.parameters(spark).collect()} == {"location", "scale"}
    assert found.predictions.where("truth is null").count() == rows.where("d = 0").count()
