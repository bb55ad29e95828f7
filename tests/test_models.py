"""Recipes, least squares, classifiers, mixed and survival models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldspark.functions.hashing import hash01
from foldspark.functions.distributions import t_quantile
from foldspark.operators.correlation import correlation_tests, mean_inference, paired_t_test
from foldspark.operators.correlation import with_p_value as correlation_p
from foldspark.operators.linear import (
    fit_columns,
    nested_f_test,
    regression_by,
    simple_regression_by,
    with_p_value,
)
from foldspark.operators.missing import predict_rows
from foldspark.operators.mixed import fit_mixed
from foldspark.operators.models import (
    decision_tree,
    fit_linear,
    linear_reg,
    logistic_reg,
    multinom_reg,
    rand_forest,
)
from foldspark.operators.recipe import (
    Recipe,
    all_nominal_predictors,
    contains,
    formula,
    starts_with,
)
from foldspark.operators.resample import bootstraps, mc_cv, vfold_cv
from foldspark.operators.splines import NaturalSpline
from foldspark.operators.survival import fit_survival
from foldspark.plans.workflow import Workflow, fit_resamples, fit_set, workflow_set


def _normal(seed, key="id"):
    """A standard normal from two hashes."""
    u, v = hash01(f"{seed}a", key), hash01(f"{seed}b", key)
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * np.pi * v)


@pytest.fixture(scope="module")
def plots(spark):
    """A table with a signal, a hot level and levels of very different sizes."""
    level = (
        F.when(hash01("l", "id") < 0.34, "hot").when(hash01("l", "id") < 0.36, "rare")
        .otherwise(F.concat(F.lit("l"), F.floor(hash01("m", "id") * 8).cast("string")))
    )
    return spark.range(1500).select(
        "id", (hash01("x", "id") * 10 + 1).alias("x"), (hash01("z", "id") * 4).alias("z"),
        level.alias("level"), F.when(hash01("s", "id") < 0.5, "A").otherwise("B").alias("style"),
        _normal("e").alias("noise"),
    ).withColumn(
        "y", 2 * F.log10("x") + F.sin("z") + F.when(F.col("level") == "hot", 1.5).otherwise(0.0) + 0.3 * F.col("noise")
    ).repartition(4).persist()


def _design(df, columns):
    table = df.toPandas()
    x = np.column_stack([np.ones(len(table)), *[table[c] for c in columns]])
    return x, table


def test_least_squares_matches_numpy(plots):
    fit = fit_columns(plots, "y", ["x", "z"])
    x, table = _design(plots, ["x", "z"])
    beta, rss, _, _ = np.linalg.lstsq(x, table["y"], rcond=None)
    assert fit.estimate == pytest.approx(beta)
    cov = rss[0] / (len(x) - 3) * np.linalg.inv(x.T @ x)
    assert fit.std_error == pytest.approx(np.sqrt(np.diag(cov)))
    assert fit.r_squared == pytest.approx(1 - rss[0] / ((table["y"] - table["y"].mean()) ** 2).sum())


def test_formula_equals_matrix_interface(plots):
    a = fit_linear(formula(plots, "y", ["x", "z"]).prep(plots), plots)
    assert a.estimate == pytest.approx(fit_columns(plots, "y", ["x", "z"]).estimate)


def test_collinear_term_is_missing(spark):
    rows = [(float(i), 2.0 * i, 3.0 * i + (i % 3)) for i in range(20)]
    fit = fit_columns(spark.createDataFrame(rows, "x double, twice double, y double"), "y", ["x", "twice"])
    tidy = {r["term"]: r for r in fit.tidy_rows()}
    assert tidy["twice"]["estimate"] is None and tidy["twice"]["p_value"] is None
    assert fit.rank == 2 and tidy["x"]["estimate"] == pytest.approx(3.0, abs=0.05)


def test_large_offsets_keep_their_digits(spark):
    rows = [(1.7e9 + i, 5.0 + 0.25 * i) for i in range(300)]
    fit = fit_columns(spark.createDataFrame(rows, "t double, y double"), "y", ["t"])
    assert fit.estimate[1] == pytest.approx(0.25, rel=1e-9) and fit.rss == pytest.approx(0.0, abs=1e-9)


def test_exact_lines_per_group(spark):
    rows = [("a", 1.0, 3.0), ("a", 2.0, 5.0), ("a", 4.0, 9.0), ("b", 0.0, 1.0), ("b", 1.0, 0.5), ("b", 3.0, -0.5), ("c", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    tidy = {(r["g"], r["term"]): r["estimate"] for r in simple_regression_by(df, ["g"], "y", "x").collect()}
    assert tidy["a", "x"] == pytest.approx(2.0) and tidy["a", "(Intercept)"] == pytest.approx(1.0)
    assert tidy["b", "x"] == pytest.approx(-0.5) and tidy["b", "(Intercept)"] == pytest.approx(1.0)
    assert tidy["c", "x"] is None


def test_grouped_regression_equals_filtered(plots):
    table = with_p_value(simple_regression_by(plots, ["level"], "y", "x"), 2)
    general = {(r["level"], r["term"]): r for r in regression_by(plots, ["level"], "y", ["x"]).collect()}
    for r in table.collect():
        one = general[r["level"], r["term"]]
        assert one["estimate"] == pytest.approx(r["estimate"]) and one["std_error"] == pytest.approx(r["std_error"])
        assert one["p_value"] == pytest.approx(r["p_value"], abs=1e-9)
    hot = fit_columns(plots.where("level = 'hot'"), "y", ["x"])
    assert general["hot", "x"]["estimate"] == pytest.approx(hot.estimate[1])


def test_nested_models(spark, plots):
    small = fit_linear(formula(plots, "y", ["x", "style"]).prep(plots), plots)
    big = fit_linear(formula(plots, "y", ["x", "style"], pairwise=True).prep(plots), plots)
    row = nested_f_test(spark, small, big).where("model = 'big'").first()
    assert big.rss <= small.rss and row["statistic"] >= 0
    # one extra term: F is the square of its t
    assert row["statistic"] == pytest.approx(big.tidy_rows()[-1]["statistic"] ** 2)
    assert row["p_value"] == pytest.approx(big.tidy_rows()[-1]["p_value"], abs=1e-9)


def test_paired_test_is_the_intercept_only_model(plots):
    paired = paired_t_test(plots, "x", "z", t_quantile).first()
    diff = plots.withColumn("d", F.col("x") - F.col("z"))
    only = fit_linear(formula(diff, "d").prep(diff), diff).tidy_rows()[0]
    for a, b in (("estimate", "estimate"), ("statistic", "statistic"), ("conf_low", "conf_low"), ("p_value", "p_value")):
        assert paired[a] == pytest.approx(only[b], rel=1e-7, abs=1e-12)
    assert mean_inference(plots, F.col("x"), t_quantile).first()["n"] == 1500


def test_correlation_with_missing_pairs(spark):
    rows = [(1.0, 2.0, 1.0), (2.0, None, 1.0), (3.0, 5.0, 1.0), (4.0, 4.0, 1.0), (5.0, 9.0, 1.0)]
    df = spark.createDataFrame(rows, "y double, x double, flat double")
    got = {r["predictor"]: r for r in correlation_p(correlation_tests(df, "y", ["x", "flat"])).collect()}
    assert got["x"]["n"] == 4 and got["x"]["estimate"] == pytest.approx(np.corrcoef([1, 3, 4, 5], [2, 5, 4, 9])[0, 1])
    assert got["flat"]["estimate"] is None and got["flat"]["p_value"] is None


def test_missing_predictors(spark, plots):
    fitted = Workflow(Recipe.of(plots, "y", ["x"]), linear_reg()).fit(plots)
    new = spark.createDataFrame([(None,), (2.0,), (3.0,)], "x double")
    passed = predict_rows(fitted, new, "pass").collect()
    assert len(passed) == 3 and sum(r["pred"] is None for r in passed) == 1
    assert predict_rows(fitted, new, "omit").count() == 2
    with pytest.raises(Exception, match="missing values"):
        predict_rows(fitted, new, "fail").collect()


# ---------------------------------------------------------------- recipes

def test_log_guard(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (10.0,)], "v double").withColumn("y", F.lit(1.0))
    baked = Recipe.of(df, "y", ["v"]).step_log("v", base=10).prep(df).bake(df, [])
    assert [r["v"] for r in baked.collect()] == [None, None, 1.0]


@pytest.mark.parametrize(("threshold", "kept"), [(0.01, ["a", "b", "c"]), (0.02, ["a", "b"]), (0.05, ["a"])])
def test_rare_levels(spark, threshold, kept):
    df = spark.createDataFrame([(v, 1.0) for v in "a" * 97 + "b" * 2 + "c"], "v string, y double")
    prepared = Recipe.of(df, "y", ["v"]).step_other("v", threshold=threshold).prep(df)
    assert prepared.learned[0]["v"] == kept
    new = spark.createDataFrame([("a", 1.0), ("new", 1.0), (None, 1.0)], "v string, y double")
    assert [r["v"] for r in prepared.bake(new, []).collect()] == ["a", "other", None]


def test_unseen_level_has_no_dummies(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 4.0)], "v string, y double")
    prepared = Recipe.of(df, "y", ["v"]).step_dummy("v").prep(df)
    new = spark.createDataFrame([("c", 1.0), ("z", 1.0), (None, 1.0)], "v string, y double")
    rows = prepared.bake(new, []).collect()
    assert [tuple(r) for r in rows] == [(0.0, 1.0), (None, None), (None, None)]
    fitted = Workflow(prepared.recipe, linear_reg()).fit(df)
    assert [r["pred"] for r in fitted.predict(new).collect()] == [pytest.approx(4.0), None, None]


def test_roles_and_unknown_columns(plots):
    recipe = Recipe.of(plots, "y", ["x", "id"]).update_role("id", new_role="identifier")
    assert recipe.prep(plots).terms == ["x"]
    with pytest.raises(ValueError, match="not a column"):
        recipe.update_role("address", new_role="identifier")
    with pytest.raises(ValueError, match="not a column"):
        Recipe.of(plots, "y", ["nothing"])


def test_recipe_variants_share_their_start(spark, plots):
    basic = Recipe.of(plots, "y", ["x", "style"]).step_dummy("style")
    longer = basic.step_interact("x", starts_with("style_"))
    assert len(basic.steps) == 1 and len(longer.steps) == 2
    assert [r["type"] for r in longer.tidy(spark).orderBy("number").collect()] == ["dummy", "interact"]
    assert longer.prep(plots).terms == ["x", "style_B", "x_x_style_B"]


def test_spline_is_natural_and_matches_its_column(spark):
    spline = NaturalSpline([0.0, 1.0, 2.5, 2.5, 7.0, 10.0])
    assert spline.size == 5
    outside = spline.values(np.array([-3.0, -2.0, -1.0, 11.0, 12.0, 13.0]))
    assert outside[0] - 2 * outside[1] + outside[2] == pytest.approx(0, abs=1e-12)
    assert outside[3] - 2 * outside[4] + outside[5] == pytest.approx(0, abs=1e-12)
    at = np.linspace(-1, 11, 49)
    df = spark.createDataFrame([(float(v),) for v in at], "x double").coalesce(1)
    got = np.array([r[0] for r in df.select(spline.column(F.col("x"))).collect()])
    assert got == pytest.approx(spline.values(at))
    # the space contains every straight line
    x = np.column_stack([np.ones(49), spline.values(at)])
    assert np.linalg.lstsq(x, at, rcond=None)[1].sum() == pytest.approx(0, abs=1e-9)


def test_spline_needs_variation(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 3, "x double, y double")
    with pytest.raises(ValueError, match="two distinct"):
        Recipe.of(df, "y", ["x"]).step_ns("x", deg_free=3).prep(df)


def test_normalize_and_components(plots):
    rows = plots.select("y", F.col("x").alias("a_SF"), (F.col("x") * 2 + F.col("noise") * 0.01).alias("b_SF"), F.col("z").alias("c_SF"))
    recipe = Recipe.of(rows, "y").step_normalize(contains("SF")).step_pca(contains("SF"), threshold=0.95)
    prepared = recipe.prep(rows)
    assert prepared.terms == ["PC1", "PC2"]
    table = prepared.bake(rows).toPandas()
    assert table["PC1"].mean() == pytest.approx(0, abs=1e-9)
    assert np.corrcoef(table["PC1"], table["PC2"])[0, 1] == pytest.approx(0, abs=1e-8)
    assert sum(prepared.learned[1]["variance"]) == pytest.approx(3.0)


# ---------------------------------------------------------------- resampled fits

def _full_recipe(df):
    return (
        Recipe.of(df, "y", ["level", "x", "style", "z"])
        .step_log("x", base=10).step_other("level", threshold=0.05).step_dummy(all_nominal_predictors())
        .step_interact("x", starts_with("style_")).step_ns("z", deg_free=4)
    )


@pytest.mark.parametrize("kind", ["folds", "monte_carlo", "bootstrap"])
def test_all_resamples_equal_separate_fits(plots, kind):
    """One shared pass gives the fits that a loop over the resamples would."""
    make = {
        "folds": lambda: vfold_cv(plots, "id", 3, seed=2),
        "monte_carlo": lambda: mc_cv(plots, "id", 0.7, times=2, seed=2),
        "bootstrap": lambda: bootstraps(plots, "id", times=2, seed=2),
    }
    sets = make[kind]()
    pooled = Recipe.of(plots, "y", ["level", "x", "style"]).step_other("level", threshold=0.05)
    pooled = pooled.step_dummy(all_nominal_predictors()).step_interact("x", starts_with("style_"))
    members = {
        "plain": Workflow(Recipe.of(plots, "y", ["x", "z"]), linear_reg()),
        "pooled": Workflow(pooled, linear_reg()),
        "splines": Workflow(_full_recipe(plots), linear_reg()),
    }
    result = fit_resamples(members, sets)
    for n, w in members.items():
        for i in sets.ids:
            alone = w.fit(sets.analysis(i))
            assert alone.recipe.terms == list(result.fits[n, i].terms[1:])
            assert result.fits[n, i].estimate == pytest.approx(alone.model.fit.estimate, rel=1e-6, abs=1e-8, nan_ok=True)
            assert result.fits[n, i].std_error == pytest.approx(alone.model.fit.std_error, rel=1e-6, nan_ok=True)


def test_set_of_workflows_equals_single_fits(plots):
    members = workflow_set({"a": Recipe.of(plots, "y", ["x"]), "b": _full_recipe(plots)}, {"lm": linear_reg()})
    assert list(members) == ["a_lm", "b_lm"]
    together = fit_set(members, plots)
    for n, w in members.items():
        assert together[n].model.fit.estimate == pytest.approx(w.fit(plots).model.fit.estimate, nan_ok=True)


def test_fitted_score_equals_design_product(plots):
    fitted = Workflow(_full_recipe(plots), linear_reg()).fit(plots)
    scored = fitted.predict(plots).withColumn("d", fitted.recipe.design()).toPandas()
    design = np.column_stack([np.ones(len(scored)), np.stack(scored["d"])])
    assert scored["pred"].to_numpy() == pytest.approx(design @ fitted.model.fit.estimate)


# ---------------------------------------------------------------- other learners

def test_logistic_engines_agree_and_solve_the_score_equations(plots):
    rows = plots.withColumn("yes", F.when(F.col("noise") + 0.4 * F.col("x") - 2 > 0, "TRUE").otherwise("FALSE"))
    recipe = Recipe.of(rows, "yes", ["x", "z", "style"]).step_dummy("style")
    newton = Workflow(recipe, logistic_reg()).fit(rows)
    built_in = Workflow(recipe, logistic_reg().set_engine("spark_logistic")).fit(rows)
    assert newton.model.coefficients == pytest.approx(built_in.model.coefficients, rel=1e-3, abs=1e-4)
    gap = F.when(F.col("yes") == "TRUE", 1.0).otherwise(0.0) - F.col("pred_TRUE")
    scored = newton.predict(rows, "prob")
    sums = scored.agg(F.sum(gap), F.sum(gap * F.col("x"))).first()
    assert max(abs(v) for v in sums) < 1e-4
    classes = newton.predict(scored, "class")
    wrong = classes.where((F.col("pred_class") == "TRUE") != (F.col("pred_TRUE") > 0.5)).count()
    assert wrong == 0


def test_multinomial_engines_agree(plots):
    rows = plots.withColumn("band", F.when(F.col("y") > 2.2, "high").when(F.col("y") > 1.2, "mid").otherwise("low"))
    recipe = Recipe.of(rows, "band", ["x", "z"])
    newton = Workflow(recipe, multinom_reg()).fit(rows)
    built_in = Workflow(recipe, multinom_reg().set_engine("spark_logistic")).fit(rows)
    assert newton.model.levels == ("high", "low", "mid")
    assert newton.model.coefficients == pytest.approx(built_in.model.coefficients, rel=1e-2, abs=1e-3)
    total = newton.predict(rows, "prob").select(F.max(F.abs(F.col("pred_high") + F.col("pred_low") + F.col("pred_mid") - 1))).first()[0]
    assert total < 1e-9


def test_logistic_needs_two_levels(plots):
    with pytest.raises(ValueError, match="two levels"):
        Workflow(Recipe.of(plots, "level", ["x"]), logistic_reg()).fit(plots)


def test_trees_fit_better_in_training(plots):
    train, test = plots.where(hash01("t", "id") < 0.7), plots.where(hash01("t", "id") >= 0.7)
    recipe = Recipe.of(plots, "y", ["x", "z", "level", "style"])
    for spec in (decision_tree(min_n=2, max_depth=8), rand_forest(trees=15, min_n=2, max_depth=8)):
        fitted = Workflow(recipe, spec).fit(train)
        error = [
            fitted.predict(df).select(F.sqrt(F.avg((F.col("y") - F.col("pred")) ** 2))).first()[0] for df in (train, test)
        ]
        spread = test.agg(F.stddev_samp("y")).first()[0]
        assert error[0] < error[1] < spread
    new = plots.limit(3).withColumn("level", F.lit("never seen"))
    assert all(r["pred"] is not None for r in fitted.predict(new).collect())


def test_penalty_shrinks(plots):
    recipe = Recipe.of(plots, "y", ["x", "z"])
    plain = Workflow(recipe, linear_reg()).fit(plots).model.fit.estimate
    lasso = Workflow(recipe, linear_reg(penalty=0.2)).fit(plots).model.fit.estimate
    assert np.abs(lasso[1:]).sum() < np.abs(plain[1:]).sum()


@pytest.mark.parametrize("penalty, mixture", [(0.3, 1.0), (0.05, 1.0), (0.1, 0.4), (0.2, 0.0), (0.0, 1.0)])
def test_elastic_net_meets_its_optimality_conditions(plots, penalty, mixture):
    rows = plots.withColumns({"twin": F.col("x") + 0.1 * F.col("z"), "same": F.lit(3.0)})
    names = ["x", "z", "twin", "same"]
    fit = Workflow(Recipe.of(rows, "y", names), linear_reg(penalty=penalty, mixture=mixture)).fit(rows).model.fit
    data = rows.select(*names, "y").toPandas().dropna()
    x, y = data[names].to_numpy(float), data["y"].to_numpy(float)
    spread = x.std(axis=0)
    rest = y - fit.estimate[0] - x @ fit.estimate[1:]
    assert abs(rest.mean()) < 1e-9 and fit.estimate[4] == 0
    for j in range(3):
        b = fit.estimate[j + 1] * spread[j]
        pull = (x[:, j] - x[:, j].mean()) @ rest / len(y) / spread[j] - penalty * (1 - mixture) * b
        if b == 0:
            assert abs(pull) <= penalty * mixture + 1e-9
        else:
            assert pull == pytest.approx(penalty * mixture * np.sign(b), abs=1e-8)


def test_penalties_of_one_recipe_over_folds_share_their_cross_products(plots, monkeypatch):
    from foldspark.operators import gram as gram_module
    from foldspark.plans import workflow as module

    folds = vfold_cv(plots, "id", 3)
    recipe = Recipe.of(folds.df, "y", ["x", "z"])
    widths = []
    real = module.grams
    monkeypatch.setattr(module, "grams", lambda df, sides, members: widths.append(len(members)) or real(df, sides, members))
    penalties = [0.5, 0.1, 0.01]
    found = fit_resamples({str(p): Workflow(recipe, linear_reg(penalty=p)) for p in penalties}, folds)
    assert widths == [1] and gram_module.grams is real
    one = Workflow(recipe, linear_reg(penalty=0.1)).fit(folds.analysis("Fold02"))
    assert found.fits["0.1", "Fold02"].estimate == pytest.approx(one.model.fit.estimate, rel=1e-8)
    assert found.collect_metrics().count() == 9


def test_engine_names():
    with pytest.raises(ValueError):
        linear_reg().set_engine("unknown")
    with pytest.raises(ValueError):
        linear_reg().set_mode("classification")


def test_mixed_model_recovers_simulated_truth(spark):
    rows = spark.range(12000).select(
        "id", F.floor(hash01("g", "id") * 150).cast("string").alias("g"), (hash01("w", "id") * 2 - 1).alias("w"),
        F.when(hash01("s", "id") < 0.5, "A").otherwise("B").alias("style"), _normal("r").alias("e"),
    ).withColumn(
        "y", 1 + 0.7 * (F.col("style") == "B").cast("double") + 0.8 * _normal("b0", "g") + 0.5 * _normal("b1", "g") * F.col("w") + 0.6 * F.col("e")
    )
    prepared = Recipe.of(rows, "y", ["style"]).step_dummy("style").prep(rows)
    fit = fit_mixed(prepared, rows, "g", "w")
    assert fit.groups == 150 and fit.fixed[1] == pytest.approx(0.7, abs=0.05)
    assert np.sqrt(fit.sigma2) == pytest.approx(0.6, abs=0.02)
    assert np.sqrt(np.diag(fit.random_cov)) == pytest.approx([0.8, 0.5], abs=0.12)
    assert fit.converged


def test_a_search_cut_short_says_so(spark, plots, monkeypatch):
    from foldspark.operators import mixed

    monkeypatch.setattr(mixed, "_ROUNDS", 1)
    prepared = Recipe.of(plots, "y", ["x"]).prep(plots)
    with pytest.warns(UserWarning, match="not converged"):
        assert not fit_mixed(prepared, plots, "level", "z").converged


def test_separable_classes_are_reported(spark):
    rows = spark.range(40).select(F.col("id").cast("double").alias("x"), F.when(F.col("id") < 20, "a").otherwise("b").alias("k"))
    with pytest.warns(UserWarning, match="no finite fit"):
        fitted = Workflow(Recipe.of(rows, "k", ["x"]), logistic_reg()).fit(rows)
    assert not fitted.model.converged and fitted.model.iterations > 1


@pytest.mark.parametrize("width", [3, 30])
def test_rows_with_nan_or_null_are_left_out_of_any_width(spark, width):
    names = [f"x{i}" for i in range(width)]
    rng = np.random.default_rng(width)
    block = rng.normal(size=(200, width))
    y = block[:, 0] - 2 * block[:, 1] + rng.normal(size=200)
    data = [[*map(float, r), float(v)] for r, v in zip(block, y)]
    clean = spark.createDataFrame(data, [*names, "y"])
    odd = [[float("nan"), *[1.0] * (width - 1), 5.0], [*[1.0] * (width - 1), float("inf"), 5.0], [*[1.0] * (width - 1), None, 5.0]]
    dirty = clean.unionByName(spark.createDataFrame(odd, clean.schema))
    fits = [fit_linear(formula(df, "y", names).prep(clean), df) for df in (clean, dirty)]
    assert fits[0].n == fits[1].n == 200
    assert fits[1].estimate == pytest.approx(fits[0].estimate, rel=1e-9, abs=1e-12)


def test_survival_recovers_simulated_truth(spark):
    u = hash01("u", "id")
    rows = spark.range(6000).select(
        "id", (hash01("a", "id") * 4).alias("age"), F.when(hash01("k", "id") < 0.5, "p").otherwise("q").alias("k"), u.alias("u")
    )
    scale = F.when(F.col("k") == "p", 0.5).otherwise(0.9)
    life = F.exp(1 + 0.3 * F.col("age") + scale * F.log(-F.log(1 - F.col("u"))))
    cut = hash01("c", "id") * 20
    rows = rows.withColumns({"t": F.greatest(F.least(life, cut), F.lit(1e-6)), "d": (life <= cut).cast("int")})
    fit = fit_survival(rows, "t", "d", ["age"], strata="k")
    assert fit.estimate == pytest.approx([1.0, 0.3], abs=0.08)
    assert [fit.scale["p"], fit.scale["q"]] == pytest.approx([0.5, 0.9], abs=0.05)

    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import AFTSurvivalRegression

    one = fit_survival(rows, "t", "d", ["age"])
    table = VectorAssembler(inputCols=["age"], outputCol="f").transform(rows.withColumn("d", F.col("d").cast("double")))
    built_in = AFTSurvivalRegression(featuresCol="f", labelCol="t", censorCol="d", tol=1e-9, maxIter=300).fit(table)
    assert one.estimate == pytest.approx([built_in.intercept, built_in.coefficients[0]], rel=1e-3)
    assert one.scale["all"] == pytest.approx(built_in.scale, rel=1e-3)


def test_prediction_intervals_of_a_wide_design(spark):
    """200 columns, one of them aliased, against the plain formula; a missing value leaves the bounds missing."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(600, 200))
    x[:, 199] = x[:, 0] + x[:, 1]
    y = x[:, 0] + rng.normal(size=600)
    names = [f"c{i}" for i in range(200)]
    rows = spark.createDataFrame([[*map(float, r), float(v)] for r, v in zip(x, y)], [*names, "y"])
    fit = fit_linear(formula(rows, "y", names).prep(rows), rows)
    full = np.hstack([np.ones((600, 1)), x[:, :199]])
    inverse = np.linalg.inv(full.T @ full)
    new = spark.createDataFrame([([*map(float, r)],) for r in x[:50]] + [([None] + [1.0] * 199,), (None,)], "d array<double>")
    low, high = fit.interval(F.lit(0.0), F.col("d"))
    got = [(r["low"], r["high"]) for r in new.coalesce(1).select(low.alias("low"), high.alias("high")).collect()]
    from foldspark.functions.distributions import t_quantile

    for r, (a, b) in zip(full[:50], got):
        half = t_quantile(0.975, 400) * np.sqrt(fit.sigma2 * (1 + r @ inverse @ r))
        assert (a, b) == (pytest.approx(-half, rel=1e-8), pytest.approx(half, rel=1e-8))
    assert got[50:] == [(None, None)] * 2
