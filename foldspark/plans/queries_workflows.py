"""Queries over workflows, resampled fits, model comparison and plot data."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window, functions as F

from foldspark.functions.distributions import normal_quantile_of, t_quantile
from foldspark.operators.compare import (
    bootstrap_draws,
    contrast_models,
    differences,
    metric_matrix,
    summarize_contrast,
)
from foldspark.operators.correlation import (
    correlation_matrix,
    correlation_tests,
    paired_t_test,
)
from foldspark.operators.models import linear_reg, logistic_reg, mixed_reg, multinom_reg, rand_forest, survival_reg
from foldspark.operators.ordered import grouped_quantiles
from foldspark.operators.plotdata import (
    binned_scatter,
    group_lines,
    histogram,
    normal_quantiles,
    ordered_levels,
    residuals,
    smoother,
)
from foldspark.operators.recipe import Recipe, all_nominal_predictors, formula, starts_with
from foldspark.operators.resample import Resample, ResampleSet, testing, training, vfold_cv
from foldspark.plans.queries_features import rounded
from foldspark.plans.queries_models import _LINE_X, _corr_sql, ols2_sql, survival_sql, survival_table
from foldspark.plans.queries_resample import FOLD_SEED, SALES_SPLIT_SQL, folds_sql, hash_sql, sales_split
from foldspark.plans.registry import query
from foldspark.plans.tables import SALES_SQL, STUDENTS_SQL, sales, students
from foldspark.plans.tuning import grid, tunable, tune, tune_grid
from foldspark.plans.workflow import (
    Workflow,
    fit_resamples,
    fit_set,
    last_fit,
    rank_workflows,
    workflow_set,
)
from foldspark.session import hold
from foldspark.sources.tables import read_table

POOL = 0.04
_TRAIN = f"WITH {SALES_SPLIT_SQL},\ntrain AS (SELECT * FROM split WHERE in_train)"
_FOLDS = f"{_TRAIN},\n{folds_sql('train', 'sale_key')},\nks AS (SELECT unnest(range(1, 11)) AS k)"
_ID = "'Fold' || lpad(CAST({k} AS VARCHAR), 2, '0')"


def _area_sql(name: str = "area") -> str:
    """Out-of-fold predictions of price on log area."""
    return (
        f"{name}_c AS (SELECT k, regr_intercept(price, log10(area)) AS a, regr_slope(price, log10(area)) AS b, "
        f"sqrt(greatest(regr_syy(price, log10(area)) - regr_sxy(price, log10(area))*regr_slope(price, log10(area)), 0)/(count(*)-2)/regr_sxx(price, log10(area))) AS se "
        f"FROM folds JOIN ks ON fold <> k GROUP BY k),\n"
        f"{name}_p AS (SELECT 'area_lm' AS wflow_id, {_ID.format(k='k')} AS id, sale_key, price AS t, a + b*log10(area) AS e FROM folds JOIN {name}_c ON fold = k)"
    )


def _pooled_sql(threshold: float = POOL, name: str = "pool", label: str = "district_lm") -> str:
    """Out-of-fold predictions from pooled district means, pooled again in every fold."""
    return (
        f"{name}_n AS (SELECT k, district, count(*) AS n, sum(price) AS s FROM folds JOIN ks ON fold <> k GROUP BY 1, 2),\n"
        f"{name}_g AS (SELECT k, district, n, s, CASE WHEN n >= {threshold} * sum(n) OVER (PARTITION BY k) THEN district ELSE 'other' END AS g FROM {name}_n),\n"
        f"{name}_m AS (SELECT k, g, sum(s)/sum(n) AS m FROM {name}_g GROUP BY 1, 2),\n"
        f"{name}_p AS (SELECT '{label}' AS wflow_id, {_ID.format(k='f.fold')} AS id, sale_key, price AS t, m AS e FROM folds f "
        f"LEFT JOIN {name}_g g ON g.k = f.fold AND g.district = f.district LEFT JOIN {name}_m m ON m.k = f.fold AND m.g = coalesce(g.g, 'other'))"
    )


def _fold_metrics_sql(source: str, name: str = "fm") -> str:
    return (
        f"{name} AS (SELECT wflow_id, id, 'rmse' AS metric, sqrt(avg((t-e)*(t-e))) AS estimate FROM {source} WHERE e IS NOT NULL GROUP BY 1, 2 "
        f"UNION ALL SELECT wflow_id, id, 'rsq', power(corr(t, e), 2) FROM {source} WHERE e IS NOT NULL GROUP BY 1, 2 "
        f"UNION ALL SELECT wflow_id, id, 'mae', avg(abs(t-e)) FROM {source} WHERE e IS NOT NULL GROUP BY 1, 2)"
    )


_BOTH = f"{_FOLDS},\n{_area_sql()},\n{_pooled_sql()},\nboth_p AS (SELECT * FROM area_p UNION ALL SELECT * FROM pool_p),\n{_fold_metrics_sql('both_p')}"


def _recipes(df):
    area = Recipe.of(df, "price", ["area"]).step_log("area", base=10)
    district = Recipe.of(df, "price", ["district"]).step_other("district", threshold=POOL).step_dummy("district")
    return area, district


def sales_folds(spark, folder):
    return vfold_cv(training(sales_split(spark, folder)), "sale_key", 10, seed=FOLD_SEED)


def two_models(spark, folder):
    """Two workflows over the same ten folds."""
    folds = sales_folds(spark, folder)
    area, district = _recipes(folds.df)
    members = workflow_set({"area": area, "district": district}, {"lm": linear_reg()})
    return fit_resamples(members, folds)


# ---------------------------------------------------------------- workflows

@query(
    "k1_workflow",
    f"{_TRAIN}, tl AS (SELECT *, log10(area) AS la FROM train),\n{ols2_sql('tl', 'price', 'la', 'year_built')} "
    "SELECT sale_key, round(b0 + b1*log10(area) + b2*year_built, 6) + 0.0 AS pred FROM split, fit WHERE NOT in_train",
)
def workflow_fit(spark, folder):
    """Recipe and model fitted together, then applied to the test side."""
    split = sales_split(spark, folder)
    recipe = Recipe.of(split.df, "price", ["area", "year_built"]).step_log("area", base=10)
    fitted = Workflow(recipe, linear_reg()).fit(training(split))
    return rounded(fitted.predict(testing(split)).select("sale_key", "pred"))


_LOCATIONS_SQL = (
    f"{_TRAIN},\n{ols2_sql('train', 'price', 'longitude', 'latitude')}, "
    "g AS (SELECT style, avg(price) AS m FROM train GROUP BY 1), g0 AS (SELECT m FROM g WHERE style = 'AUTOMOBILE'), r AS ("
    "SELECT 'longitude_lm' AS wflow_id, '(Intercept)' AS term, regr_intercept(price, longitude) AS v FROM train UNION ALL SELECT 'longitude_lm', 'longitude', regr_slope(price, longitude) FROM train "
    "UNION ALL SELECT 'latitude_lm', '(Intercept)', regr_intercept(price, latitude) FROM train UNION ALL SELECT 'latitude_lm', 'latitude', regr_slope(price, latitude) FROM train "
    "UNION ALL SELECT 'coords_lm', '(Intercept)', b0 FROM fit UNION ALL SELECT 'coords_lm', 'longitude', b1 FROM fit UNION ALL SELECT 'coords_lm', 'latitude', b2 FROM fit "
    "UNION ALL SELECT 'style_lm', '(Intercept)', m FROM g0 UNION ALL SELECT 'style_lm', 'style_' || style, g.m - g0.m FROM g, g0 WHERE style <> 'AUTOMOBILE') "
)


def _locations(df):
    return workflow_set(
        {
            "longitude": formula(df, "price", ["longitude"]),
            "latitude": formula(df, "price", ["latitude"]),
            "coords": formula(df, "price", ["longitude", "latitude"]),
            "style": formula(df, "price", ["style"]),
        },
        {"lm": linear_reg()},
    )


@query(
    "k4_workflow_set",
    f"{_LOCATIONS_SQL} SELECT wflow_id, CAST(count(*) AS BIGINT) AS terms FROM r GROUP BY 1",
)
def location_set(spark, folder):
    """Four preprocessors crossed with one model; the size of each fitted member."""
    split = sales_split(spark, folder)
    fitted = fit_set(_locations(split.df), training(split))
    rows = [(n, len(f.model.fit.terms)) for n, f in fitted.items()]
    return spark.createDataFrame(rows, "wflow_id string, terms long")


@query("k5_fit_all", f"{_LOCATIONS_SQL} SELECT wflow_id, term, round(v, 6) + 0.0 AS estimate FROM r")
def fit_all(spark, folder):
    """All members fitted from one pass over the training rows."""
    split = sales_split(spark, folder)
    fitted = fit_set(_locations(split.df), training(split))
    rows = [(n, r["term"], r["estimate"]) for n, f in fitted.items() for r in f.model.fit.tidy_rows()]
    return rounded(spark.createDataFrame(rows, "wflow_id string, term string, estimate double"))


@query(
    "k6_last_fit",
    f"{_TRAIN},\n{ols2_sql('train', 'price', 'longitude', 'latitude')}, x AS (SELECT price AS t, b0 + b1*longitude + b2*latitude AS e FROM split, fit WHERE NOT in_train) "
    "SELECT 'rmse' AS metric, round(sqrt(avg((t-e)*(t-e))), 6) + 0.0 AS estimate FROM x UNION ALL SELECT 'rsq', round(power(corr(t, e), 2), 6) + 0.0 FROM x "
    "UNION ALL SELECT 'mae', round(avg(abs(t-e)), 6) + 0.0 FROM x",
)
def final_fit(spark, folder):
    split = sales_split(spark, folder)
    result = last_fit(Workflow(Recipe.of(split.df, "price", ["longitude", "latitude"]), linear_reg()), split)
    return rounded(result.metrics.select("metric", "estimate"))


@query(
    "k7_fit_resamples",
    f"{_FOLDS},\n{_pooled_sql()},\n{_fold_metrics_sql('pool_p')} SELECT id, metric, round(estimate, 6) + 0.0 AS estimate FROM fm",
)
def resampled_pooling(spark, folder):
    """Rare levels are pooled again inside every analysis set."""
    folds = sales_folds(spark, folder)
    result = fit_resamples({"district_lm": Workflow(_recipes(folds.df)[1], linear_reg())}, folds)
    return rounded(result.collect_metrics(summarize=False).select("id", "metric", "estimate"))


@query("k7_fit_resamples_full_recipe")
def resampled_full_recipe(spark, folder):
    """Log, pooling, dummies, interactions and splines, estimated again in every fold."""
    folds = sales_folds(spark, folder)
    recipe = (
        Recipe.of(folds.df, "price", ["district", "area", "year_built", "style", "latitude", "longitude"])
        .step_log("area", base=10)
        .step_other("district", threshold=0.01)
        .step_dummy(all_nominal_predictors())
        .step_interact("area", starts_with("style_"))
        .step_ns("latitude", "longitude", deg_free=20)
    )
    return rounded(fit_resamples(Workflow(recipe, linear_reg()), folds).collect_metrics(summarize=False))


# ---------------------------------------------------------------- classifiers over resamples

_TIER = "CASE WHEN price >= 5.5 THEN 'dear' ELSE 'cheap' END"
_RANGE = "CASE WHEN price >= 5.6 THEN 'c_top' WHEN price >= 5.4 THEN 'b_mid' ELSE 'a_low' END"
_SIZE = "CASE WHEN area < 3500 THEN 'small' WHEN area < 8000 THEN 'middle' ELSE 'large' END"
_TIERED = f"{_FOLDS},\nf AS (SELECT *, {_TIER} AS tier, {_RANGE} AS span, {_SIZE} AS size, {_ID.format(k='fold')} AS id FROM folds)"


def tiered_folds(spark, folder):
    folds = sales_folds(spark, folder)
    return replace(folds, df=folds.df.withColumns({"tier": F.expr(_TIER), "span": F.expr(_RANGE), "size": F.expr(_SIZE)}))


def _class_metrics_sql(source: str, by: str = "id, ", levels=("cheap", "dear")) -> str:
    """Metrics of (truth, pred, score), the score being the first level's probability."""
    first, second = levels
    over = f"PARTITION BY {by.rstrip(', ')}" if by else ""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    return f"""
cells AS (SELECT {by}count(*)::DOUBLE AS n, count(*) FILTER (truth = pred)::DOUBLE AS hits,
  count(*) FILTER (truth = '{first}' AND pred = '{first}')::DOUBLE AS tp, count(*) FILTER (truth = '{second}' AND pred = '{first}')::DOUBLE AS fp,
  count(*) FILTER (truth = '{first}' AND pred = '{second}')::DOUBLE AS fn, count(*) FILTER (truth = '{second}' AND pred = '{second}')::DOUBLE AS tn FROM {source} {group}),
steps AS (SELECT {by}score, count(*) FILTER (truth = '{first}')::DOUBLE AS pos, count(*) FILTER (truth = '{second}')::DOUBLE AS neg FROM {source} GROUP BY {by}score),
wins AS (SELECT *, sum(neg) OVER ({over} ORDER BY score) - neg / 2 AS beaten FROM steps),
cm AS (SELECT {by}'accuracy' AS metric, hits / n AS estimate FROM cells
  UNION ALL SELECT {by}'mcc', (tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0) FROM cells
  UNION ALL SELECT {by}'roc_auc', sum(pos * beaten) / (sum(pos) * sum(neg)) FROM wins {group})"""


_ONE_FACTOR = f"""{_TIERED},
rate AS (SELECT k, size, avg((tier = 'dear')::INTEGER) AS dear FROM f JOIN ks ON fold <> k GROUP BY 1, 2),
oof AS (SELECT id, sale_key, tier AS truth, CASE WHEN dear > 0.5 THEN 'dear' ELSE 'cheap' END AS pred, 1 - dear AS score
  FROM f JOIN rate ON k = fold AND rate.size = f.size)"""


def _one_factor(spark, folder):
    """With one factor the fit of every fold is known: the shares of its analysis set."""
    folds = tiered_folds(spark, folder)
    recipe = Recipe.of(folds.df, "tier", ["size"]).step_dummy("size")
    return fit_resamples({"size_glm": Workflow(recipe, logistic_reg())}, folds)


@query(
    "k7_classification",
    f"{_ONE_FACTOR},{_class_metrics_sql('oof')} SELECT 'size_glm' AS wflow_id, id, metric, round(estimate, 6) + 0.0 AS estimate FROM cm",
)
def resampled_classes(spark, folder):
    """Accuracy, Matthews correlation and area of every fold's logistic regression."""
    found = _one_factor(spark, folder).collect_metrics(summarize=False)
    return rounded(found.select("wflow_id", "id", "metric", "estimate"))


@query(
    "k10_class_predictions",
    f"{_ONE_FACTOR} SELECT id, sale_key AS \"row\", truth, pred AS pred_class, round(score, 5) + 0.0 AS pred_cheap, round(1 - score, 5) + 0.0 AS pred_dear FROM oof",
)
def out_of_fold_classes(spark, folder):
    """Out-of-fold classes and probabilities."""
    found = _one_factor(spark, folder).predictions
    return rounded(found.select("id", "row", "truth", "pred_class", "pred_cheap", "pred_dear"), 5)


@query(
    "k8_class_coefficients",
    f"{_ONE_FACTOR}, logit AS (SELECT {_ID.format(k='k')} AS id, size, ln(dear / (1 - dear)) AS v FROM rate), base AS (SELECT id, v FROM logit WHERE size = 'large') "
    "SELECT id, 'dear' AS y_level, '(Intercept)' AS term, round(v, 4) + 0.0 AS estimate FROM base "
    "UNION ALL SELECT logit.id, 'dear', 'size_' || size, round(logit.v - base.v, 4) + 0.0 FROM logit JOIN base ON base.id = logit.id WHERE size <> 'large'",
)
def fold_class_coefficients(spark, folder):
    """The saved fits of all folds: log odds and their differences."""
    return rounded(_one_factor(spark, folder).coefficients(spark).drop("wflow_id"), 4)


@query(
    "k7_multinomial",
    f"""{_TIERED},
share AS (SELECT k, size, avg((span = 'a_low')::INTEGER) AS a, avg((span = 'b_mid')::INTEGER) AS b, avg((span = 'c_top')::INTEGER) AS c
  FROM f JOIN ks ON fold <> k GROUP BY 1, 2)
SELECT id, sale_key AS "row", span AS truth, CASE WHEN a >= b AND a >= c THEN 'a_low' WHEN b >= c THEN 'b_mid' ELSE 'c_top' END AS pred_class,
  round(a, 5) + 0.0 AS pred_a_low, round(b, 5) + 0.0 AS pred_b_mid, round(c, 5) + 0.0 AS pred_c_top
FROM f JOIN share ON k = fold AND share.size = f.size""",
)
def resampled_multinomial(spark, folder):
    """Three classes: out-of-fold probabilities of a multinomial regression on one factor."""
    folds = tiered_folds(spark, folder)
    recipe = Recipe.of(folds.df, "span", ["size"]).step_dummy("size")
    found = fit_resamples(Workflow(recipe, multinom_reg()), folds).predictions
    return rounded(found.select("id", "row", "truth", "pred_class", "pred_a_low", "pred_b_mid", "pred_c_top"), 5)


# predictors and their units
_GENERAL_X = {"area": 1000.0, "latitude": 1.0, "longitude": 1.0}


@query(
    "k7_class_score_equations",
    f"{_TIERED} SELECT w.wflow_id, {_ID.format(k='k')} AS id, CAST(count(*) FILTER (tier = 'dear') AS DOUBLE) AS total_n, "
    + ", ".join(f"round(sum({x} / {u}::DOUBLE) FILTER (tier = 'dear'), 1) + 0.0 AS total_{x}" for x, u in _GENERAL_X.items())
    + " FROM f JOIN ks ON fold <> k CROSS JOIN (VALUES ('plain_glm'), ('pooled_glm')) AS w(wflow_id) GROUP BY 1, 2",
)
def resampled_score_equations(spark, folder):
    """Two workflows over ten folds in common passes: at every fit, probabilities times a predictor sum to what was observed."""
    folds = tiered_folds(spark, folder)
    folds = replace(folds, df=folds.df.withColumns({x: F.col(x) / u for x, u in _GENERAL_X.items()}))
    plain = Recipe.of(folds.df, "tier", list(_GENERAL_X))
    # districts are pooled again in every fold
    pooled = Recipe.of(folds.df, "tier", [*_GENERAL_X, "district"]).step_other("district", threshold=POOL).step_dummy("district")
    members = workflow_set({"plain": plain, "pooled": pooled}, {"glm": logistic_reg()})
    found = fit_resamples(members, folds)
    weights = {i: r.weight for i, r in folds.resamples.items()}
    prepared = {n: w.recipe.prep_resamples(folds.df, weights) for n, w in members.items()}
    sums = []
    for (n, i), model in found.fits.items():
        p = weights[i] / (1 + F.exp(-prepared[n][i].score(model.coefficients[0])))
        sums.append(
            F.struct(
                F.lit(n).alias("wflow_id"), F.lit(i).alias("id"), F.round(F.sum(p), 1).alias("total_n"),
                *[F.round(F.sum(p * F.col(x)), 1).alias(f"total_{x}") for x in _GENERAL_X],
            )
        )
    return folds.df.agg(F.array(*sums).alias("e")).select(F.inline("e"))


@query(
    "k6_last_fit_classes",
    f"WITH {SALES_SPLIT_SQL}, f AS (SELECT *, {_TIER} AS tier, {_SIZE} AS size FROM split), "
    "rate AS (SELECT size, avg((tier = 'dear')::INTEGER) AS dear FROM f WHERE in_train GROUP BY 1), "
    "oof AS (SELECT tier AS truth, CASE WHEN dear > 0.5 THEN 'dear' ELSE 'cheap' END AS pred, 1 - dear AS score FROM f JOIN rate USING (size) WHERE NOT in_train),"
    f"{_class_metrics_sql('oof', '')} SELECT metric, round(estimate, 6) + 0.0 AS estimate FROM cm",
)
def final_class_fit(spark, folder):
    """A classifier fitted on the training side, its metrics on the test side."""
    split = sales_split(spark, folder)
    split = replace(split, df=split.df.withColumns({"tier": F.expr(_TIER), "size": F.expr(_SIZE)}))
    recipe = Recipe.of(split.df, "tier", ["size"]).step_dummy("size")
    return rounded(last_fit(Workflow(recipe, logistic_reg()), split).metrics.select("metric", "estimate"))


# ---------------------------------------------------------------- mixed and survival models as workflow models

_YEARS = range(1992, 1999)
_BIN = "CAST(least(floor(area / 1000), 10) AS INTEGER)"
#: Mean prices by size and year: every size has every year, so the fit has a closed form.
_CELL = f"WITH {SALES_SQL}, cell AS (SELECT {_BIN} AS bin, CAST(year_built AS INTEGER) AS year, avg(price) AS y FROM sales GROUP BY 1, 2)"
#: Per resample k (the year left out): variances of a balanced one-way layout, a negative one at its bound.
_ONE_WAY = """
side AS (SELECT k, cell.* FROM cell JOIN ks ON year <> k),
per_bin AS (SELECT k, bin, avg(y) AS mean, count(*)::DOUBLE AS m, sum(y * y) - count(*) * avg(y) * avg(y) AS within FROM side GROUP BY 1, 2),
whole AS (SELECT k, avg(mean) AS mu, max(m) AS m, count(*)::DOUBLE AS a, var_samp(mean) AS v, sum(within) AS ssw FROM per_bin GROUP BY 1),
squares AS (SELECT *, a * m AS n, m * v AS msb, ssw / (a * m - a) AS msw FROM whole),
fit AS (SELECT k, mu, m, n, greatest((msb - msw) / m, 0) AS sb2, CASE WHEN msb > msw THEN msw ELSE (ssw + (a - 1) * msb) / (n - 1) END AS s2 FROM squares),
effect AS (SELECT per_bin.k, bin, m.mu, m.m * sb2 / (m.m * sb2 + s2) * (mean - m.mu) AS b FROM per_bin JOIN fit m ON m.k = per_bin.k)"""


def _cells(spark, folder):
    rows = sales(spark, folder).groupBy(F.expr(_BIN).alias("bin"), F.col("year_built").cast("int").alias("year"))
    return hold(rows.agg(F.avg("price").alias("y"))).withColumn("cell_key", F.col("bin") * 10000 + F.col("year"))


def _size_workflow(df):
    return Workflow().with_model(mixed_reg(), group="bin").with_variables(df, "y", ["bin"])


@query(
    "k3_mixed_workflow",
    f"{_CELL}, ks AS (SELECT 0 AS k), {_ONE_WAY} SELECT 'fixed' AS effect, '(Intercept)' AS term, round(mu, 5) + 0.0 AS estimate, "
    "round(sqrt((s2 + m * sb2) / n), 5) + 0.0 AS std_error FROM fit "
    "UNION ALL SELECT 'random', 'sd_intercept', round(sqrt(sb2), 5) + 0.0, NULL FROM fit UNION ALL SELECT 'random', 'sd_residual', round(sqrt(s2), 5) + 0.0, NULL FROM fit",
)
def mixed_workflow(spark, folder):
    """A random intercept per size class, the group named beside the variables."""
    rows = _cells(spark, folder)
    return rounded(_size_workflow(rows).fit(rows).tidy(spark), 5)


@query(
    "k3_mixed_predictions",
    f"{_CELL}, ks AS (SELECT 0 AS k), {_ONE_WAY} SELECT c.bin + 2 AS bin, year, round(coalesce(e.mu + e.b, f.mu), 5) + 0.0 AS pred "
    "FROM cell c CROSS JOIN fit f LEFT JOIN effect e ON e.bin = c.bin + 2",
)
def mixed_predictions(spark, folder):
    """Group effects are joined to new rows; a group that was not seen has the fixed effects only."""
    rows = _cells(spark, folder)
    new = rows.select((F.col("bin") + 2).alias("bin"), "year")
    return rounded(_size_workflow(rows).fit(rows).predict(new).select("bin", "year", "pred"), 5)


def _years_left_out(spark, folder):
    rows = _cells(spark, folder).withColumn("__year", F.col("year"))
    sets = {f"Year{y}": Resample((F.col("__year") != y).cast("int"), F.col("__year") == y) for y in _YEARS}
    return ResampleSet(rows, "cell_key", sets)


_LEFT_OUT = f"{_CELL}, ks AS (SELECT unnest(range({_YEARS.start}, {_YEARS.stop})) AS k), {_ONE_WAY}"


@query(
    "k3_mixed_resamples",
    f"{_LEFT_OUT} SELECT 'Year' || year AS id, cell.bin * 10000 + year AS \"row\", round(y, 5) + 0.0 AS truth, round(mu + b, 5) + 0.0 AS pred "
    "FROM cell JOIN effect ON effect.k = year AND effect.bin = cell.bin",
)
def mixed_resamples(spark, folder):
    """One year left out at a time: all fits are searched together, and one join scores them."""
    folds = _years_left_out(spark, folder)
    return rounded(fit_resamples(_size_workflow(folds.df), folds).predictions.select("id", "row", "truth", "pred"), 5)


@query(
    "k3_mixed_parameters",
    f"{_LEFT_OUT} SELECT 'Year' || k AS id, 'fixed' AS part, '(Intercept)' AS term, round(mu, 5) + 0.0 AS estimate FROM fit "
    "UNION ALL SELECT 'Year' || k, 'random', 'sd_intercept', round(sqrt(sb2), 5) + 0.0 FROM fit UNION ALL SELECT 'Year' || k, 'random', 'sd_residual', round(sqrt(s2), 5) + 0.0 FROM fit",
)
def mixed_parameters(spark, folder):
    """The fits of all resamples as a table."""
    folds = _years_left_out(spark, folder)
    found = fit_resamples(_size_workflow(folds.df), folds).parameters(spark)
    return rounded(found.select("id", "part", "term", "estimate"), 5)


def _survival_workflow(df):
    spec = Workflow().with_model(survival_reg(), event="fustat", strata="load")
    return spec.with_variables(df, "futime", ["age", "load"])


@query(
    "k3_survival_workflow",
    f"{survival_sql()} SELECT load, CAST(sum(fustat) AS DOUBLE) AS events FROM u GROUP BY 1",
)
def survival_workflow(spark, folder):
    """One scale per load: at the fit, the sum of (hazard - event) times the standardised log time of a stratum is its events."""
    rows = hold(survival_table(spark, folder).withColumn("age", F.col("age") / 1000))
    fitted = _survival_workflow(rows).fit(rows)
    scored = fitted.predict(rows, "time").withColumn("scale", fitted.model.fit.scale_of("load"))
    z = (F.log("futime") - F.log("pred")) / F.col("scale")
    return scored.groupBy("load").agg(F.round(F.sum((F.exp(z) - F.col("fustat")) * z), 3).alias("events"))


@query(
    "k3_survival_resamples",
    f"{survival_sql()}, {folds_sql('u', 'person_id', 5)}, ks AS (SELECT unnest(range(1, 6)) AS k) "
    f"SELECT {_ID.format(k='k')} AS id, load, CAST(sum(fustat) AS DOUBLE) AS events FROM folds JOIN ks ON fold <> k GROUP BY 1, 2",
)
def survival_resamples(spark, folder):
    """The same identity at the fit of every fold's analysis set."""
    folds = vfold_cv(hold(survival_table(spark, folder).withColumn("age", F.col("age") / 1000)), "person_id", 5, seed=FOLD_SEED)
    result = fit_resamples(_survival_workflow(folds.df), folds)
    sums = []
    for (_, i), fit in result.fits.items():
        z = (F.log("futime") - (float(fit.estimate[0]) + F.col("age") * float(fit.estimate[1]))) / fit.scale_of("load")
        own = folds.resamples[i].weight * (F.exp(z) - F.col("fustat")) * z
        sums.append(F.struct(F.lit(i).alias("id"), F.round(F.sum(own), 2).alias("events")))
    return folds.df.groupBy("load").agg(F.array(*sums).alias("e")).select("load", F.inline("e"))


@query(
    "k9_collect_metrics",
    f"{_FOLDS},\n{_area_sql()},\n{_fold_metrics_sql('area_p')} SELECT metric, round(avg(estimate), 6) + 0.0 AS mean, CAST(count(*) AS BIGINT) AS n, "
    "round(stddev_samp(estimate)/sqrt(count(*)), 6) + 0.0 AS std_err FROM fm GROUP BY 1",
)
def summarized_metrics(spark, folder):
    folds = sales_folds(spark, folder)
    result = fit_resamples({"area_lm": Workflow(_recipes(folds.df)[0], linear_reg())}, folds)
    return rounded(result.collect_metrics().select("metric", "mean", "n", "std_err"))


@query(
    "k10_collect_predictions",
    f"{_FOLDS},\n{_area_sql()} SELECT id, sale_key AS \"row\", round(t, 6) + 0.0 AS truth, round(e, 6) + 0.0 AS pred FROM area_p",
)
def out_of_fold(spark, folder):
    folds = sales_folds(spark, folder)
    result = fit_resamples({"area_lm": Workflow(_recipes(folds.df)[0], linear_reg())}, folds)
    return rounded(result.predictions.select("id", "row", "truth", "pred"))


@query(
    "k10_fold_coefficients",
    f"{_FOLDS},\n{_area_sql()} SELECT {_ID.format(k='k')} AS id, '(Intercept)' AS term, round(a, 6) + 0.0 AS estimate FROM area_c "
    f"UNION ALL SELECT {_ID.format(k='k')}, 'area', round(b, 6) + 0.0 FROM area_c",
)
def fold_coefficients(spark, folder):
    folds = sales_folds(spark, folder)
    result = fit_resamples({"area_lm": Workflow(_recipes(folds.df)[0], linear_reg())}, folds)
    return rounded(result.coefficients(spark).select("id", "term", "estimate"))


@query("k11_workflow_map", f"{_BOTH} SELECT wflow_id, id, metric, round(estimate, 6) + 0.0 AS estimate FROM fm")
def resampled_set(spark, folder):
    return rounded(two_models(spark, folder).collect_metrics(summarize=False).drop("estimator"))


@query("k11_four_models")
def four_models(spark, folder):
    """Three linear workflows and a forest over the same folds."""
    folds = sales_folds(spark, folder)
    basic = (
        Recipe.of(folds.df, "price", ["district", "area", "year_built", "style", "latitude", "longitude"])
        .step_log("area", base=10)
        .step_other("district", threshold=0.01)
        .step_dummy(all_nominal_predictors())
    )
    interact = basic.step_interact("area", starts_with("style_"))
    splines = interact.step_ns("latitude", "longitude", deg_free=50)
    linear = workflow_set({"basic": basic, "interact": interact, "splines": splines}, {"lm": linear_reg()}, cross=False)
    plain = Recipe.of(folds.df, "price", ["district", "area", "year_built", "style", "latitude", "longitude"])
    forest = {"random_forest": Workflow(plain, rand_forest(trees=10, max_depth=5))}
    return rounded(fit_resamples({**linear, **forest}, folds).collect_metrics())


@query(
    "k12_rank_workflows",
    f"{_BOTH}, s AS (SELECT wflow_id, avg(estimate) AS m, stddev_samp(estimate)/sqrt(count(*)) AS se FROM fm WHERE metric = 'rsq' GROUP BY 1) "
    "SELECT wflow_id, 'rsq' AS metric, round(m, 6) + 0.0 AS mean, round(se, 6) + 0.0 AS std_err, CAST(rank() OVER (ORDER BY m DESC) AS INTEGER) AS rank, "
    "round(m - 1.96*se, 6) + 0.0 AS lower, round(m + 1.96*se, 6) + 0.0 AS upper FROM s",
)
def ranked_workflows(spark, folder):
    return rounded(rank_workflows(two_models(spark, folder).collect_metrics(), "rsq", higher_is_better=True))


@query(
    "p12_filter_metrics",
    f"{_BOTH} SELECT wflow_id, round(avg(estimate), 6) + 0.0 AS mean, CAST(count(*) AS BIGINT) AS n FROM fm WHERE metric = 'rmse' GROUP BY 1",
)
def rmse_only(spark, folder):
    metrics = two_models(spark, folder).collect_metrics().where("metric = 'rmse'")
    return rounded(metrics.select("wflow_id", "mean", "n"))


@query(
    "p16_bind_columns",
    f"{_TRAIN},\n{ols2_sql('train', 'price', 'longitude', 'latitude')} SELECT round(price, 6) + 0.0 AS price, round(b0 + b1*longitude + b2*latitude, 6) + 0.0 AS pred FROM split, fit WHERE NOT in_train",
)
def truth_with_predictions(spark, folder):
    """Predictions arrive on the row of their truth."""
    split = sales_split(spark, folder)
    fitted = Workflow(Recipe.of(split.df, "price", ["longitude", "latitude"]), linear_reg()).fit(training(split))
    return rounded(fitted.predict(testing(split)).select("price", "pred"))


@query(
    "w6_rows_of_worst_predictions",
    f"{_FOLDS},\n{_area_sql()}, w AS (SELECT sale_key, t - e AS residual FROM area_p ORDER BY abs(round(t - e, 9)) DESC, sale_key LIMIT 2) "
    "SELECT s.sale_key, s.district, s.style, round(residual, 6) + 0.0 AS residual FROM w JOIN sales s ON s.sale_key = w.sale_key",
)
def worst_rows(spark, folder):
    """The two largest out-of-fold residuals, with their source rows."""
    folds = sales_folds(spark, folder)
    result = fit_resamples({"area_lm": Workflow(_recipes(folds.df)[0], linear_reg())}, folds)
    scored = residuals(result.predictions, "truth").select(F.col("row").alias("sale_key"), "residual")
    # an ordering key at fixed precision keeps near ties in key order
    worst = scored.orderBy(F.abs(F.round("residual", 9)).desc(), "sale_key").limit(2)
    # two rows by construction of the limit
    rows = folds.df.join(F.broadcast(worst), "sale_key")
    return rounded(rows.select("sale_key", "district", "style", "residual"))


# ---------------------------------------------------------------- tuning

_THRESHOLDS = [0.02, 0.039, 0.041]


_CANDIDATES = ",\n".join(_pooled_sql(t, f"c{i}", f"candidate_{i:02d}") for i, t in enumerate(_THRESHOLDS, start=1))
_CANDIDATE_P = "cand_p AS (" + " UNION ALL ".join(f"SELECT * FROM c{i}_p" for i in range(1, len(_THRESHOLDS) + 1)) + ")"


@query(
    "k15_tune_grid",
    f"{_FOLDS},\n{_CANDIDATES},\n{_CANDIDATE_P},\n{_fold_metrics_sql('cand_p')}, th AS (SELECT unnest(['candidate_01', 'candidate_02', 'candidate_03']) AS wflow_id, unnest({_THRESHOLDS})::DOUBLE AS threshold) "
    "SELECT wflow_id, threshold, metric, round(avg(estimate), 6) + 0.0 AS mean, CAST(count(estimate) AS BIGINT) AS n FROM fm JOIN th USING (wflow_id) GROUP BY 1, 2, 3",
)
def tuned_threshold(spark, folder):
    """Three pooling thresholds scored on the shared folds in one pass."""
    folds = sales_folds(spark, folder)
    recipe = Recipe.of(folds.df, "price", ["district"]).step_other("district", threshold=tune()).step_dummy("district")
    result = tune_grid(Workflow(recipe, linear_reg()), grid(spark, {"threshold": _THRESHOLDS}), folds)
    return rounded(result.collect_metrics().select("wflow_id", "threshold", "metric", "mean", "n"))


# ---------------------------------------------------------------- comparing models

_WIDE = f"{_BOTH}, w AS (SELECT id, max(CASE WHEN wflow_id = 'area_lm' THEN estimate END) AS area_lm, max(CASE WHEN wflow_id = 'district_lm' THEN estimate END) AS district_lm FROM fm WHERE metric = 'rsq' GROUP BY 1)"
_MODELS = ["area_lm", "district_lm"]


def rsq_matrix(spark, folder):
    table = two_models(spark, folder).collect_metrics(summarize=False)
    return metric_matrix(table, "rsq", _MODELS)


@query("b1_metric_matrix", f"{_WIDE} SELECT id, round(area_lm, 6) + 0.0 AS area_lm, round(district_lm, 6) + 0.0 AS district_lm FROM w")
def fold_matrix(spark, folder):
    return rounded(rsq_matrix(spark, folder))


@query("b2_differences", f"{_WIDE} SELECT id, round(area_lm - district_lm, 6) + 0.0 AS difference FROM w")
def fold_differences(spark, folder):
    table = differences(rsq_matrix(spark, folder), "area_lm", "district_lm")
    return rounded(table.select("id", "difference"))


@query(
    "b3_fold_correlation",
    f"{_WIDE}, c AS (SELECT corr(area_lm, district_lm) AS r, CAST(count(*) AS BIGINT) AS n FROM w) SELECT n, round(r, 5) + 0.0 AS estimate, "
    "round(tanh(atanh(r) - 1.959963984540054/sqrt(n-3)), 5) + 0.0 AS conf_low, round(tanh(atanh(r) + 1.959963984540054/sqrt(n-3)), 5) + 0.0 AS conf_high FROM c",
)
def fold_correlation(spark, folder):
    tests = correlation_tests(rsq_matrix(spark, folder), "area_lm", ["district_lm"])
    return rounded(tests.select("n", "estimate", "conf_low", "conf_high"), 5)


@query(
    "b3_fold_correlation_matrix",
    f"{_WIDE} SELECT 'area_lm' AS term, CAST(NULL AS DOUBLE) AS area_lm, round(corr(area_lm, district_lm), 5) + 0.0 AS district_lm FROM w "
    "UNION ALL SELECT 'district_lm', round(corr(area_lm, district_lm), 5) + 0.0, CAST(NULL AS DOUBLE) FROM w",
)
def fold_correlations(spark, folder):
    return rounded(correlation_matrix(rsq_matrix(spark, folder), _MODELS), 5)


# nine degrees of freedom: the tail of t in closed form, and its 97.5 % quantile
_T9 = (
    "1 - 2/pi() * (atan(abs(t)/3) + sin(atan(abs(t)/3)) * (cos(atan(abs(t)/3)) + 2.0/3*power(cos(atan(abs(t)/3)), 3) "
    "+ 8.0/15*power(cos(atan(abs(t)/3)), 5) + 48.0/105*power(cos(atan(abs(t)/3)), 7)))"
)


@query(
    "i12_paired_t_test_of_folds",
    f"{_WIDE}, s AS (SELECT avg(area_lm - district_lm) AS m, stddev_samp(area_lm - district_lm)/sqrt(count(*)) AS se FROM w), q AS (SELECT *, m/se AS t FROM s) "
    f"SELECT round(m, 5) + 0.0 AS estimate, round(m - 2.2621571628540993*se, 5) + 0.0 AS conf_low, round(m + 2.2621571628540993*se, 5) + 0.0 AS conf_high, round({_T9}, 5) + 0.0 AS p_value FROM q",
)
def paired_folds(spark, folder):
    """Two models over ten folds: the paired test, with its p-value."""
    test = paired_t_test(rsq_matrix(spark, folder), "area_lm", "district_lm", t_quantile)
    return rounded(test.select("estimate", "conf_low", "conf_high", "p_value"), 5)


_N_DRAWS = 500
_DRAWS_SQL = (
    f"{_BOTH}, d AS (SELECT unnest(range(1, {_N_DRAWS + 1})) AS draw), s AS (SELECT unnest(range(1, 11)) AS slot), "
    "pk AS (SELECT draw, slot, CAST(floor(('0x' || substr(md5(concat_ws('|', '1104', CAST(draw AS VARCHAR), CAST(slot AS VARCHAR))), 1, 13))::BIGINT / 4503599627370496.0 * 10) AS BIGINT) + 1 AS pick FROM d, s), "
    "dr AS (SELECT draw, wflow_id AS model, avg(estimate) AS posterior FROM pk JOIN fm ON fm.id = 'Fold' || lpad(CAST(pick AS VARCHAR), 2, '0') WHERE metric = 'rsq' GROUP BY 1, 2), "
    "co AS (SELECT draw, max(CASE WHEN model = 'area_lm' THEN posterior END) - max(CASE WHEN model = 'district_lm' THEN posterior END) AS difference FROM dr GROUP BY 1) "
)


def _contrast(spark, folder):
    table = two_models(spark, folder).collect_metrics(summarize=False)
    return contrast_models(bootstrap_draws(table, "rsq", _N_DRAWS, 10, seed=1104), "area_lm", "district_lm")


@query("b4_contrast", f"{_DRAWS_SQL} SELECT CAST(draw AS BIGINT) AS draw, round(difference, 6) + 0.0 AS difference, 'area_lm vs district_lm' AS contrast FROM co")
def model_contrast(spark, folder):
    return rounded(_contrast(spark, folder))


@query(
    "b5_contrast_summary",
    f"{_DRAWS_SQL} SELECT 'area_lm vs district_lm' AS contrast, round(avg(CAST(difference > 0 AS INTEGER)), 6) + 0.0 AS probability, round(avg(difference), 6) + 0.0 AS mean, "
    "round(quantile_cont(difference, 0.05), 6) + 0.0 AS lower, round(quantile_cont(difference, 0.95), 6) + 0.0 AS upper FROM co",
)
def contrast_summary(spark, folder):
    table = summarize_contrast(_contrast(spark, folder))
    return rounded(table.select("contrast", "probability", "mean", "lower", "upper"))


@query(
    "b6_practical_equivalence",
    f"{_DRAWS_SQL} SELECT 'area_lm vs district_lm' AS contrast, round(avg(CAST(difference < -0.02 AS INTEGER)), 6) + 0.0 AS pract_neg, "
    "round(avg(CAST(difference BETWEEN -0.02 AND 0.02 AS INTEGER)), 6) + 0.0 AS pract_equiv, round(avg(CAST(difference > 0.02 AS INTEGER)), 6) + 0.0 AS pract_pos FROM co",
)
def practical_equivalence(spark, folder):
    table = summarize_contrast(_contrast(spark, folder), size=0.02)
    return rounded(table.select("contrast", "pract_neg", "pract_equiv", "pract_pos"))


# ---------------------------------------------------------------- plot data

def _hist_sql(value: str, source: str, where: str = "", by: str = "") -> str:
    keys = f"{by}, " if by else ""
    return (
        f"x AS (SELECT {keys}{value} AS x FROM {source} {where}), r AS (SELECT min(x) AS lo, (max(x) - min(x)) / 50 AS w FROM x), "
        f"b AS (SELECT {keys}least(CAST(floor((x - lo) / w) AS INTEGER), 49) AS bin, lo, w FROM x, r) "
        f"SELECT {keys}bin, CAST(count(*) AS BIGINT) AS n, round(lo + bin * w, 6) + 0.0 AS bin_low FROM b GROUP BY {keys}bin, lo, w"
    )


@query("v1_histogram", f"WITH {_hist_sql('l_extendedprice', 'lineitem')}")
def price_histogram(spark, folder):
    return rounded(histogram(read_table(spark, "lineitem", folder), "l_extendedprice"))


@query("v1_histogram_log_axis", f"WITH {_hist_sql('log10(o_totalprice)', 'orders')}")
def log_histogram(spark, folder):
    return rounded(histogram(read_table(spark, "orders", folder), "o_totalprice", log10=True))


@query(
    "v2_group_lines",
    f"WITH {STUDENTS_SQL}, f AS (SELECT sex, regr_intercept(gpa, age) AS a, regr_slope(gpa, age) AS b, min(age) AS lo, max(age) AS hi FROM students GROUP BY 1) "
    "SELECT sex, lo AS x, round(a + b*lo, 6) + 0.0 AS y FROM f UNION ALL SELECT sex, hi, round(a + b*hi, 6) + 0.0 FROM f",
)
def lines_by_group(spark, folder):
    lines = group_lines(students(spark, folder).select("sex", "age", "gpa"), ["sex"], "age", "gpa")
    return lines.select("sex", "x", F.round("y", 6).alias("y"))


@query("v3_smoother")
def spline_curves(spark, folder):
    """Spline curves for 2, 5, 20 and 100 terms."""
    rows = hold(sales(spark, folder).select("area", "price"))
    return rounded(smoother(rows, "area", "price", [2, 5, 20, 100]))


@query(
    "v4_residuals",
    f"{_TRAIN},\n{ols2_sql('train', 'price', 'longitude', 'latitude')} SELECT sale_key, round(b0 + b1*longitude + b2*latitude, 6) + 0.0 AS pred, "
    "round(price - (b0 + b1*longitude + b2*latitude), 6) + 0.0 AS residual FROM train, fit",
)
def fitted_residuals(spark, folder):
    train = training(sales_split(spark, folder))
    fitted = Workflow(Recipe.of(train, "price", ["longitude", "latitude"]), linear_reg()).fit(train)
    return rounded(residuals(fitted.predict(train), "price").select("sale_key", "pred", "residual"))


class _Sql(str):
    """Just enough arithmetic on SQL text to write a formula once for both engines."""

    def _with(self, sign, other, swapped=False):
        a, b = (other, self) if swapped else (self, other)
        return _Sql(f"({a!s} {sign} {b!s})")

    def __neg__(self):
        return _Sql(f"(-{self!s})")


for _name, _sign in {"add": "+", "sub": "-", "mul": "*", "truediv": "/"}.items():
    setattr(_Sql, f"__{_name}__", lambda a, b, sign=_sign: a._with(sign, b))
    setattr(_Sql, f"__r{_name}__", lambda a, b, sign=_sign: a._with(sign, b, True))
for _name, _sign in {"le": "<=", "ge": ">=", "lt": "<", "and": "AND"}.items():
    setattr(_Sql, f"__{_name}__", lambda a, b, sign=_sign: a._with(sign, b))

_QUANTILE_SQL = normal_quantile_of(
    _Sql("p"), lambda x: _Sql(f"sqrt({x})"), lambda x: _Sql(f"ln({x})"), lambda c, a, b: _Sql(f"(CASE WHEN {c} THEN {a} ELSE {b} END)")
)


@query(
    "v4_normal_quantiles",
    f"{_TRAIN},\n{ols2_sql('train', 'price', 'longitude', 'latitude')}, "
    "x AS (SELECT price - (b0 + b1*longitude + b2*latitude) AS e FROM train, fit), c AS (SELECT e, count(*) AS n FROM x GROUP BY 1), "
    "r AS (SELECT e, n, (sum(n) OVER (ORDER BY e) - n / 2) / (SELECT count(*) FROM x)::DOUBLE AS p FROM c) "
    f"SELECT round(e, 6) + 0.0 AS value, n, round({_QUANTILE_SQL}, 6) + 0.0 AS normal_quantile FROM r",
)
def residual_quantiles(spark, folder):
    """Residuals against normal quantiles, ranked without a global sort."""
    train = training(sales_split(spark, folder))
    fitted = Workflow(Recipe.of(train, "price", ["longitude", "latitude"]), linear_reg()).fit(train)
    return rounded(normal_quantiles(residuals(fitted.predict(train), "price"), "residual"))


_TESTS_SQL = " UNION ALL ".join(_corr_sql("l_extendedprice", x, "lineitem") for x in _LINE_X)


@query(
    "v5_estimate_intervals",
    f"WITH t AS ({_TESTS_SQL}) SELECT predictor, estimate, conf_low, conf_high, CAST(row_number() OVER (ORDER BY estimate, predictor) AS INTEGER) AS \"order\" FROM t",
)
def ordered_intervals(spark, folder):
    """Correlations with their intervals, in the order of the estimate."""
    tests = rounded(
        correlation_tests(read_table(spark, "lineitem", folder), "l_extendedprice", _LINE_X).select(
            "predictor", "estimate", "conf_low", "conf_high"
        )
    )
    # one row per predictor
    order = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("estimate", "predictor"))
    return tests.withColumn("order", order)


_CELL = "least(CAST(floor(({c} - {c}_lo) / (({c}_hi - {c}_lo) / 30)) AS INTEGER), 29)"


@query(
    "v6_binned_scatter",
    "WITH r AS (SELECT min(l_quantity) AS q_lo, max(l_quantity) AS q_hi, min(l_extendedprice) AS p_lo, max(l_extendedprice) AS p_hi FROM lineitem), "
    "x AS (SELECT l_quantity AS q, l_extendedprice AS p, r.* FROM lineitem, r) "
    f"SELECT {_CELL.format(c='q')} AS x_bin, {_CELL.format(c='p')} AS y_bin, CAST(count(*) AS BIGINT) AS n FROM x GROUP BY 1, 2",
)
def scatter(spark, folder):
    return binned_scatter(read_table(spark, "lineitem", folder), "l_quantity", "l_extendedprice")


@query(
    "v7_profile_lines",
    f"{_BOTH}, o AS (SELECT wflow_id, CAST(row_number() OVER (ORDER BY avg(estimate), wflow_id) AS INTEGER) AS \"order\" FROM fm WHERE metric = 'rsq' GROUP BY 1) "
    "SELECT f.wflow_id, id, round(estimate, 6) + 0.0 AS estimate, \"order\" FROM fm f JOIN o ON f.wflow_id = o.wflow_id WHERE metric = 'rsq'",
)
def profile_lines(spark, folder):
    """One line per fold over the models, ordered by their mean."""
    table = two_models(spark, folder).collect_metrics(summarize=False).where("metric = 'rsq'")
    order = ordered_levels(table, "wflow_id", F.avg("estimate")).select("wflow_id", "order")
    return rounded(table.join(order, "wflow_id").select("wflow_id", "id", "estimate", "order"))


@query("v8_faceted_histogram", f"WITH {_hist_sql('l_extendedprice', 'lineitem', by='l_returnflag')}")
def faceted_histogram(spark, folder):
    return rounded(histogram(read_table(spark, "lineitem", folder), "l_extendedprice", by=["l_returnflag"]))


@query(
    "z2_function_per_group",
    "SELECT event_type, round(median(value), 6) + 0.0 AS middle, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1",
)
def function_per_group(spark, folder):
    """A function of every group's rows, here its median: one pass over all groups, however many there are."""
    events = hold(read_table(spark, "events", folder).select("event_type", "value"))
    middle = grouped_quantiles(events, ["event_type"], "value", [0.5])
    counts = events.groupBy("event_type").agg(F.count("*").alias("n"))
    same = middle["event_type"].eqNullSafe(counts["event_type"])
    return counts.join(middle, same).select(counts["event_type"], F.round(F.get("quantiles", F.lit(0)), 6).alias("middle"), "n")
