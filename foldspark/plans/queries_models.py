"""Queries over models, predictions and inference."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldspark.functions.distributions import t_quantile
from foldspark.operators.correlation import correlation_matrix, correlation_tests, with_p_value as correlation_p_value
from foldspark.operators.linear import (
    fit_columns,
    nested_f_test,
    regression_by,
    simple_regression_by,
    with_p_value,
)
from foldspark.operators.mixed import fit_mixed
from foldspark.operators.models import (
    decision_tree,
    fit_linear,
    linear_reg,
    logistic_reg,
    multinom_reg,
    rand_forest,
)
from foldspark.operators.recipe import Recipe, all_nominal_predictors, formula, starts_with
from foldspark.operators.resample import initial_split, testing, training
from foldspark.operators.survival import fit_survival
from foldspark.plans.queries_features import rounded
from foldspark.plans.queries_resample import SALES_SPLIT_SQL, STRATA_SEED, sales_split
from foldspark.plans.registry import query
from foldspark.plans.tables import (
    SALES_SQL,
    DEGREES_SQL,
    FALL_SQL,
    REG_SQL,
    STUDENTS_SQL,
    degrees,
    fall_registrations,
    sales,
    students,
)
from foldspark.plans.workflow import Workflow, fit_set
from foldspark.session import hold
from foldspark.sources.tables import read_table


def ols2_sql(source: str, y: str, x1: str, x2: str, name: str = "fit") -> str:
    """Two-predictor least squares in closed form: estimates, errors, residual variance."""
    return (
        f"{name}_m AS (SELECT CAST(count(*) AS BIGINT) AS n, avg({y}) AS my, avg({x1}) AS m1, avg({x2}) AS m2 FROM {source}),\n"
        f"{name}_s AS (SELECT n, my, m1, m2, sum(({x1}-m1)*({x1}-m1)) AS s11, sum(({x2}-m2)*({x2}-m2)) AS s22, sum(({x1}-m1)*({x2}-m2)) AS s12, "
        f"sum(({x1}-m1)*({y}-my)) AS s1y, sum(({x2}-m2)*({y}-my)) AS s2y, sum(({y}-my)*({y}-my)) AS syy FROM {source}, {name}_m GROUP BY 1, 2, 3, 4),\n"
        f"{name}_d AS (SELECT *, s11*s22 - s12*s12 AS det FROM {name}_s),\n"
        f"{name}_b AS (SELECT *, (s22*s1y - s12*s2y)/det AS b1, (s11*s2y - s12*s1y)/det AS b2, s22/det AS i11, s11/det AS i22, -s12/det AS i12 FROM {name}_d),\n"
        f"{name} AS (SELECT *, my - b1*m1 - b2*m2 AS b0, syy - b1*s1y - b2*s2y AS rss, (syy - b1*s1y - b2*s2y)/(n - 3) AS s2, "
        f"1.0/n + m1*m1*i11 + m2*m2*i22 + 2*m1*m2*i12 AS i00, -(m1*i11 + m2*i12) AS i01, -(m1*i12 + m2*i22) AS i02 FROM {name}_b)"
    )


def tidy2_sql(terms: list[str], name: str = "fit", digits: int = 6) -> str:
    """Coefficient rows of the closed form."""
    parts = []
    for i, term in enumerate(["(Intercept)", *terms]):
        se = f"sqrt(s2 * i{i}{i})"
        parts.append(
            f"SELECT '{term}' AS term, round(b{i}, {digits}) + 0.0 AS estimate, round({se}, {digits}) + 0.0 AS std_error, "
            f"round(b{i} / {se}, 4) + 0.0 AS statistic FROM {name}"
        )
    return " UNION ALL ".join(parts)


def tidy2(df):
    return df.select(
        "term", F.round("estimate", 6).alias("estimate"), F.round("std_error", 6).alias("std_error"),
        F.round("statistic", 4).alias("statistic"),
    )


_STUDENT_X = f"WITH {STUDENTS_SQL},\nsx AS (SELECT *, CAST(sex = 'O' AS INTEGER)::DOUBLE AS sex_o FROM students)"
_SALES_TRAIN = f"WITH {SALES_SPLIT_SQL},\ntrain AS (SELECT * FROM split WHERE in_train)"


@query(
    "m1_least_squares",
    f"{_STUDENT_X},\n{ols2_sql('sx', 'gpa', 'age', 'sex_o')} {tidy2_sql(['age', 'sex_O'])}",
)
def least_squares(spark, folder):
    """A number and a two-level factor."""
    rows = hold(students(spark, folder).select("gpa", "age", "sex"))
    return tidy2(fit_linear(formula(rows, "gpa", ["age", "sex"]).prep(rows), rows).tidy(spark))


_GROUPED = (
    "SELECT {g}, CAST(count(*) AS BIGINT) AS n, avg({x}) AS mx, avg({y}) AS my, regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy, "
    "regr_sxy({y}, {x}) AS sxy, regr_slope({y}, {x}) AS b FROM {t} GROUP BY {g}"
)
def _p_sql(t: str, df: str) -> str:
    """Two-sided tail of Student's t for many degrees of freedom, close to six digits, shown with three."""
    z = f"(abs({t})*(1 - 0.25/({df}))/sqrt(1 + ({t})*({t})/(2.0*({df}))))"
    u = f"(1/(1 + 0.3275911*{z}/sqrt(2.0)))"
    # the complementary error function by its rational approximation
    series = f"{u}*(0.254829592 + {u}*(-0.284496736 + {u}*(1.421413741 + {u}*(-1.453152027 + {u}*1.061405429))))"
    return f"round(({series})*exp(-{z}*{z}/2), 3) + 0.0"


_GROUPED_TIDY = (
    "v AS (SELECT *, greatest(syy - b*sxy, 0)/(n - 2) AS mse FROM s) "
    "SELECT {g}, '(Intercept)' AS term, round(my - b*mx, {d}) + 0.0 AS estimate, round(sqrt(mse*(1.0/n + mx*mx/sxx)), {d}) + 0.0 AS std_error, "
    "round((my - b*mx)/sqrt(mse*(1.0/n + mx*mx/sxx)), 4) + 0.0 AS statistic, "
    + _p_sql("(my - b*mx)/sqrt(mse*(1.0/n + mx*mx/sxx))", "n - 2")
    + " AS p_value, n FROM v UNION ALL "
    "SELECT {g}, '{x}', round(b, {d}) + 0.0, round(sqrt(mse/sxx), {d}) + 0.0, round(b/sqrt(mse/sxx), 4) + 0.0, "
    + _p_sql("b/sqrt(mse/sxx)", "n - 2")
    + ", n FROM v"
)


def _tidy_by(df, by):
    return df.select(
        by, "term", F.round("estimate", 6).alias("estimate"), F.round("std_error", 6).alias("std_error"),
        F.round("statistic", 4).alias("statistic"), F.round("p_value", 3).alias("p_value"), "n",
    )


@query(
    "m2_regression_per_group",
    f"WITH {STUDENTS_SQL},\ns AS ({_GROUPED.format(g='sex', x='age', y='gpa', t='students')}), {_GROUPED_TIDY.format(g='sex', x='age', d=6)}",
)
def regression_per_group(spark, folder):
    """The analysis table, then a coefficient table per group: one Catalyst plan."""
    rows = students(spark, folder).select("sex", "age", "gpa")
    return _tidy_by(with_p_value(simple_regression_by(rows, ["sex"], "gpa", "age"), 2), "sex")


@query(
    "m2_regression_per_group_general",
    f"WITH s AS ({_GROUPED.format(g='l_suppkey', x='l_quantity', y='l_extendedprice', t='lineitem')}), {_GROUPED_TIDY.format(g='l_suppkey', x='l_quantity', d=6)}",
)
def regression_many_groups(spark, folder):
    """Any number of predictors and groups: grouped cross-products, solved per group."""
    lines = read_table(spark, "lineitem", folder)
    return _tidy_by(regression_by(lines, ["l_suppkey"], "l_extendedprice", ["l_quantity"]), "l_suppkey")


@query(
    "m3_matrix_interface",
    f"{_SALES_TRAIN},\n{ols2_sql('train', 'price', 'longitude', 'latitude')} {tidy2_sql(['longitude', 'latitude'])}",
)
def matrix_interface(spark, folder):
    train = training(sales_split(spark, folder))
    return tidy2(fit_columns(train, "price", ["longitude", "latitude"]).tidy(spark))


@query("m4_penalized_regression")
def penalized(spark, folder):
    """Lasso coefficients, on a small penalty."""
    rows = sales(spark, folder)
    recipe = Recipe.of(rows, "price", ["area", "latitude", "longitude", "style"]).step_dummy("style")
    fitted = Workflow(recipe, linear_reg(penalty=0.01)).fit(rows)
    return rounded(fitted.tidy(spark).select("term", "estimate"))


_PENALTIES = (0.2, 0.1, 0.05, 0.01, 0.001)
_MIXTURE = 0.7


@query(
    "m4_elastic_net_path",
    f"WITH {SALES_SQL}, s AS (SELECT avg(price) AS my, avg(area) AS mx, stddev_pop(area) AS sx, covar_pop(price, area) / stddev_pop(area) AS c FROM sales), "
    f"p AS (SELECT unnest([{', '.join(map(str, _PENALTIES))}]::DOUBLE[]) AS penalty), "
    f"b AS (SELECT penalty, my, mx, sign(c) * greatest(abs(c) - {_MIXTURE} * penalty, 0) / (1 + {round(1 - _MIXTURE, 3)} * penalty) / sx AS slope FROM s, p) "
    "SELECT penalty, '(Intercept)' AS term, round(my - slope * mx, 6) + 0.0 AS estimate FROM b "
    "UNION ALL SELECT penalty, 'area', round(slope * 1000, 6) + 0.0 FROM b",
)
def elastic_net_path(spark, folder):
    """One predictor: the shrunk slope (times 1000) of every penalty, all from one pass over the rows."""
    rows = hold(sales(spark, folder))
    recipe = Recipe.of(rows, "price", ["area"])
    fitted = fit_set({str(p): Workflow(recipe, linear_reg(penalty=p, mixture=_MIXTURE)) for p in _PENALTIES}, rows)
    table = [
        (float(p), term, float(v) * (1000 if term == "area" else 1))
        for p, one in fitted.items() for term, v in zip(one.model.fit.terms, one.model.fit.estimate)
    ]
    return rounded(spark.createDataFrame(table, "penalty double, term string, estimate double"))


_LASSO = 1e-5
_LASSO_X = ["area", "latitude", "longitude"]


@query(
    "m4_optimality",
    f"WITH {SALES_SQL} " + " UNION ALL ".join(f"SELECT '{x}' AS term, round({_LASSO} * sign(corr(price, {x}){'' if x == 'area' else f' - corr(area, {x}) * corr(price, area)'}), 9) + 0.0 AS pull FROM sales" for x in _LASSO_X),
)
def lasso_optimality(spark, folder):
    """At a lasso fit with a small penalty, what is left of the outcome pulls at every column with just the penalty."""
    rows = hold(sales(spark, folder))
    fitted = Workflow(Recipe.of(rows, "price", _LASSO_X), linear_reg(penalty=_LASSO)).fit(rows)
    rest = fitted.predict(rows).withColumn("rest", F.col("price") - F.col("pred"))
    pulls = [
        F.struct(F.lit(x).alias("term"), F.round(F.covar_pop("rest", x) / F.stddev_pop(x), 9).alias("pull")) for x in _LASSO_X
    ]
    return rest.agg(F.array(*pulls).alias("e")).select(F.inline("e"))


@query("m5_regression_tree")
def regression_tree(spark, folder):
    split = sales_split(spark, folder)
    recipe = Recipe.of(split.df, "price", ["longitude", "latitude", "area"])
    fitted = Workflow(recipe, decision_tree(min_n=2)).fit(training(split))
    return rounded(fitted.predict(testing(split)).select("sale_key", "price", "pred"))


@query(
    "m5_level_means",
    f"WITH {SALES_SPLIT_SQL}, m AS (SELECT district, avg(price) AS pred FROM split WHERE in_train GROUP BY 1) "
    "SELECT sale_key, round(m.pred, 6) + 0.0 AS pred FROM split JOIN m USING (district) WHERE NOT in_train",
)
def tree_of_one_factor(spark, folder):
    """A tree without a bound separates every level, so it predicts the level's mean."""
    split = sales_split(spark, folder)
    fitted = Workflow(Recipe.of(split.df, "price", ["district"]), decision_tree(min_n=1)).fit(training(split))
    return rounded(fitted.predict(testing(split)).select("sale_key", "pred"))


@query("m6_random_forest")
def random_forest(spark, folder):
    """Nominal columns enter the forest as categories, without dummies."""
    split = sales_split(spark, folder)
    recipe = Recipe.of(split.df, "price", ["district", "area", "year_built", "style", "latitude", "longitude"])
    fitted = Workflow(recipe, rand_forest(trees=20, max_depth=6)).fit(training(split))
    return rounded(fitted.predict(testing(split)).select("sale_key", "price", "pred"))


def student_split(spark, folder):
    rows = hold(students(spark, folder))
    return initial_split(rows, "row_key", 0.8, strata="gpa", seed=STRATA_SEED)


def _student_recipe(df, outcome, extra=()):
    return (
        Recipe.of(df, outcome, ["zip", "age", "paid_amt", "sex", "day_hours", *extra])
        .step_mutate(zip=lambda c: F.substring(c("zip"), 1, 5))
        .step_log("age", base=10)
        .step_log("paid_amt", base=10, offset=1)
        .step_other("zip", threshold=0.01)
        .step_dummy(all_nominal_predictors())
        .step_interact("age", starts_with("sex_"))
        .step_ns("day_hours", deg_free=2)
    )


@query("m7_logistic_regression")
def logistic(spark, folder):
    """Retention probabilities and classes on the test side."""
    split = student_split(spark, folder)
    recipe = _student_recipe(split.df, "retained", ["load", "gpa"])
    fitted = Workflow(recipe, logistic_reg()).fit(training(split))
    scored = fitted.predict(fitted.predict(testing(split), "prob"), "class")
    return rounded(scored.select("row_key", "retained", "pred_FALSE", "pred_TRUE", "pred_class"))


@query(
    "m7_logistic_two_groups",
    f"WITH {STUDENTS_SQL} SELECT sex, round(avg(CAST(retained = 'TRUE' AS INTEGER)), 5) + 0.0 AS pred_true, "
    "CAST(count(*) AS BIGINT) AS n FROM students GROUP BY sex",
)
def logistic_two_groups(spark, folder):
    """With one factor the fitted probabilities are the observed shares."""
    rows = hold(students(spark, folder).select("row_key", "retained", "sex"))
    fitted = Workflow(Recipe.of(rows, "retained", ["sex"]).step_dummy("sex"), logistic_reg()).fit(rows)
    scored = fitted.predict(rows, "prob")
    return scored.groupBy("sex").agg(
        F.round(F.avg("pred_TRUE"), 5).alias("pred_true"), F.count("*").alias("n")
    )


# predictors and their units
_SCORE_X = {"age": 1000.0, "gpa": 1.0, "paid_amt": 100_000.0}


def _observed_sql(of: str, name: str) -> str:
    return f"SELECT '{name}' AS class, CAST(count(*) FILTER ({of}) AS DOUBLE) AS total_n, " + ", ".join(
        f"round(sum({x} / {unit}::DOUBLE) FILTER ({of}), 1) + 0.0 AS total_{x}" for x, unit in _SCORE_X.items()
    ) + " FROM students"


def _score_sums(rows, fitted, classes):
    """Per class, the fitted probabilities summed, and summed against every predictor."""
    scored = fitted.predict(rows, "prob")
    entries = []
    for name in classes:
        p = F.col(f"`pred_{name}`")
        entries.append(
            F.struct(
                F.lit(name).alias("class"), F.round(F.sum(p), 1).alias("total_n"),
                *[F.round(F.sum(p * F.col(x)), 1).alias(f"total_{x}") for x in _SCORE_X],
            )
        )
    return scored.agg(F.array(*entries).alias("e")).select(F.inline("e"))


@query("m7_score_equations", f"WITH {STUDENTS_SQL} " + _observed_sql("retained = 'TRUE'", "TRUE"))
def logistic_scores(spark, folder):
    """At the fit, probabilities times a predictor sum to what was observed."""
    rows = hold(students(spark, folder).select("row_key", "retained", *[(F.col(x) / u).alias(x) for x, u in _SCORE_X.items()]))
    fitted = Workflow(Recipe.of(rows, "retained", list(_SCORE_X)), logistic_reg()).fit(rows)
    return _score_sums(rows, fitted, ["TRUE"])


@query(
    "m8_score_equations",
    f"WITH {STUDENTS_SQL} " + " UNION ALL ".join(_observed_sql(f"CAST(zip AS INTEGER) % 3 = {c}", f"z{c}") for c in range(3)),
)
def multinomial_scores(spark, folder):
    """The same for three classes."""
    third = F.concat(F.lit("z"), (F.col("zip").cast("int") % 3).cast("string"))
    rows = hold(students(spark, folder).select("row_key", third.alias("third"), *[(F.col(x) / u).alias(x) for x, u in _SCORE_X.items()]))
    fitted = Workflow(Recipe.of(rows, "third", list(_SCORE_X)), multinom_reg()).fit(rows)
    return _score_sums(rows, fitted, ["z0", "z1", "z2"])


@query("m8_multinomial_regression")
def multinomial(spark, folder):
    split = student_split(spark, folder)
    recipe = _student_recipe(split.df, "band")
    fitted = Workflow(recipe, multinom_reg()).fit(training(split))
    scored = fitted.predict(fitted.predict(testing(split), "prob"), "class")
    kept = [c for c in scored.columns if c.startswith("pred_")]
    return rounded(scored.select("row_key", "band", *[F.col(f"`{c}`") for c in kept]))


@query(
    "m8_multinomial_two_groups",
    f"WITH {STUDENTS_SQL} SELECT sex, "
    + ", ".join(
        f"round(avg(CAST(band = '{b}' AS INTEGER)), 5) + 0.0 AS {n}"
        for b, n in (("0.00-2.00", "low"), ("2.01-3.50", "middle"), ("3.51-4.00", "high"))
    )
    + " FROM students GROUP BY sex",
)
def multinomial_two_groups(spark, folder):
    rows = hold(students(spark, folder).select("row_key", "band", "sex"))
    fitted = Workflow(Recipe.of(rows, "band", ["sex"]).step_dummy("sex"), multinom_reg()).fit(rows)
    scored = fitted.predict(rows, "prob")
    names = (("0.00-2.00", "low"), ("2.01-3.50", "middle"), ("3.51-4.00", "high"))
    return scored.groupBy("sex").agg(
        *[F.round(F.avg(F.col(f"`pred_{b}`")), 5).alias(n) for b, n in names]
    )


@query("m9_mixed_model")
def mixed_model(spark, folder):
    """Random intercept and size slope per district."""
    rows = hold(sales(spark, folder)).withColumn("size", F.col("area") / 1000)
    prepared = Recipe.of(rows, "price", ["style"]).step_dummy("style").prep(rows)
    return rounded(fit_mixed(prepared, rows, group="district", slope="size").tidy(spark))


def survival_table(spark, folder):
    """Years from the first term to the first later degree, censored at the last term seen.

    The term difference is split with whole numbers: equal remainders first, then
    ranges. Only positive times can enter the model.
    """
    fall = fall_registrations(spark, folder)
    people = fall.groupBy("person_id").agg(
        F.min("term_code").alias("term_code"), F.max("term_code").alias("last_term"),
        F.min_by("age", F.struct("term_code", "row_key")).alias("age"),
        F.min_by("load", F.struct("term_code", "row_key")).alias("load"),
    )
    later = degrees(spark, folder).join(people.select("person_id", "term_code"), "person_id")
    first = later.where(F.col("grad_term") > F.col("term_code")).groupBy("person_id").agg(
        F.min("grad_term").alias("grad_term")
    )
    joined = people.join(first, "person_id", "left").withColumns(
        {c: F.col(c).cast("int") for c in ("term_code", "last_term", "grad_term")}
    )
    end = F.coalesce("grad_term", "last_term")
    gap = end - F.col("term_code")
    rest = F.pmod(gap, F.lit(100))
    days = (
        F.when(rest == 0, 4 / 12).when(rest == 20, 10 / 12).when(rest == 90, 11 / 12)
        .when(rest < 9, 5 / 12).otherwise(9 / 12)
    )
    return joined.select(
        "person_id", "age", "load",
        F.bround(gap / 100.0, 0).alias("years"),
        (rest / 100.0).alias("leftovers"),
        F.round(F.bround(gap / 100.0, 0) + days, 6).alias("futime"),
        F.when(F.col("grad_term").isNotNull(), 1).otherwise(0).alias("fustat"),
    ).where("futime > 0")


@query("m10_survival_regression")
def survival_regression(spark, folder):
    rows = hold(survival_table(spark, folder))
    fitted = fit_survival(rows.withColumn("age", F.col("age") / 1000), "futime", "fustat", ["age"], strata="load")
    return rounded(fitted.tidy(spark), 4)


@query(
    "m10_scaled_hazards",
    f"""WITH {REG_SQL},{FALL_SQL},{DEGREES_SQL},
people AS (SELECT person_id, min(term_code) AS term_code, max(term_code) AS last_term, first(load ORDER BY term_code, row_key) AS load FROM fall GROUP BY 1),
firsts AS (SELECT d.person_id, min(grad_term) AS grad_term FROM degrees d JOIN people p ON d.person_id = p.person_id WHERE grad_term > term_code GROUP BY 1)
SELECT load, CAST(sum(CASE WHEN grad_term IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE) AS hazard FROM people p LEFT JOIN firsts f ON p.person_id = f.person_id GROUP BY 1""",
)
def survival_hazards(spark, folder):
    """At the fit with one level as the only term, the cumulative hazards of a stratum sum to its events."""
    table = hold(survival_table(spark, folder))
    loads = [r["load"] for r in table.select("load").distinct().orderBy("load").collect()]
    rows = table
    for i, load in enumerate(loads[1:], start=1):
        rows = rows.withColumn(f"load_{i}", (F.col("load") == load).cast("double"))
    names = [f"load_{i}" for i in range(1, len(loads))]
    fit = fit_survival(rows, "futime", "fustat", names)
    linear = F.lit(float(fit.estimate[0]))
    for name, b in zip(names, fit.estimate[1:]):
        linear = linear + F.col(name) * float(b)
    hazard = F.exp((F.log("futime") - linear) / float(fit.scale["all"]))
    return rows.groupBy("load").agg(F.round(F.sum(hazard), 3).alias("hazard"))


@query(
    "m11_intercept_only",
    "SELECT '(Intercept)' AS term, round(avg(o_totalprice), 4) + 0.0 AS estimate, round(stddev_samp(o_totalprice) / sqrt(count(*)), 4) + 0.0 AS std_error FROM orders",
)
def intercept_only(spark, folder):
    """No predictors: the mean with its standard error."""
    orders = read_table(spark, "orders", folder).select("o_totalprice")
    fit = fit_linear(formula(orders, "o_totalprice").prep(orders), orders)
    return fit.tidy(spark).select(
        "term", F.round("estimate", 4).alias("estimate"), F.round("std_error", 4).alias("std_error")
    )


def survival_sql() -> str:
    """The survival table as ``u``."""
    return f"""WITH {REG_SQL},{FALL_SQL},{DEGREES_SQL},
people AS (SELECT person_id, min(term_code) AS term_code, max(term_code) AS last_term,
  first(age ORDER BY term_code, row_key) AS age, first(load ORDER BY term_code, row_key) AS load FROM fall GROUP BY 1),
firsts AS (SELECT d.person_id, min(grad_term) AS grad_term FROM degrees d JOIN people p ON d.person_id = p.person_id WHERE grad_term > term_code GROUP BY 1),
j AS (SELECT p.person_id, age, load, CAST(coalesce(grad_term, last_term) AS INTEGER) - CAST(term_code AS INTEGER) AS gap, grad_term FROM people p LEFT JOIN firsts f ON p.person_id = f.person_id),
t AS (SELECT person_id, age, load, round_even(gap / 100.0::DOUBLE, 0) AS years, (gap % 100) AS rest, CASE WHEN grad_term IS NOT NULL THEN 1 ELSE 0 END AS fustat FROM j),
all_times AS (SELECT person_id, age, load, years, rest / 100.0::DOUBLE AS leftovers,
  round(years + CASE WHEN rest = 0 THEN 4/12.0 WHEN rest = 20 THEN 10/12.0 WHEN rest = 90 THEN 11/12.0 WHEN rest < 9 THEN 5/12.0 ELSE 9/12.0 END::DOUBLE, 6) + 0.0 AS futime, fustat FROM t),
u AS (SELECT * FROM all_times WHERE futime > 0)"""


@query("m13_survival_table", f"{survival_sql()} SELECT * FROM u")
def survival_preparation(spark, folder):
    return survival_table(spark, folder).select("person_id", "age", "load", "years", "leftovers", "futime", "fustat")


# ---------------------------------------------------------------- prediction and inference

@query(
    "i1_predict",
    f"{_SALES_TRAIN},\n{ols2_sql('train', 'price', 'longitude', 'latitude')} "
    "SELECT sale_key, round(b0 + b1*longitude + b2*latitude, 6) + 0.0 AS pred FROM split, fit WHERE NOT in_train",
)
def predict_numbers(spark, folder):
    split = sales_split(spark, folder)
    fitted = Workflow(Recipe.of(split.df, "price", ["longitude", "latitude"]), linear_reg()).fit(training(split))
    return rounded(fitted.predict(testing(split)).select("sale_key", "pred"))


@query(
    "i2_prediction_interval",
    f"{_SALES_TRAIN},\n{ols2_sql('train', 'price', 'longitude', 'latitude')}, "
    "z AS (SELECT 1.9599639845400545::DOUBLE AS z), "
    # the t quantile by its expansion about the normal one; exact to far more digits than shown
    "q AS (SELECT fit.*, z + (z*z*z + z)/(4*(n-3)) + (5*power(z,5) + 16*power(z,3) + 3*z)/(96*power(n-3,2)) AS t FROM fit, z), "
    "p AS (SELECT sale_key, b0 + b1*longitude + b2*latitude AS pred, "
    "t*sqrt(s2*(1 + i00 + longitude*longitude*i11 + latitude*latitude*i22 + 2*longitude*i01 + 2*latitude*i02 + 2*longitude*latitude*i12)) AS half "
    "FROM split, q WHERE NOT in_train) "
    "SELECT sale_key, round(pred, 5) + 0.0 AS pred, round(pred - half, 5) + 0.0 AS pred_lower, round(pred + half, 5) + 0.0 AS pred_upper FROM p",
)
def prediction_interval(spark, folder):
    split = sales_split(spark, folder)
    fitted = Workflow(Recipe.of(split.df, "price", ["longitude", "latitude"]), linear_reg()).fit(training(split))
    scored = fitted.predict(testing(split), "pred_int")
    return rounded(scored.select("sale_key", "pred", "pred_lower", "pred_upper"), 5)


@query(
    "i4_missing_predictors",
    f"WITH x AS (SELECT l_returnflag, l_extendedprice AS y, CAST({'nullif(l_linenumber, 7)'} AS DOUBLE) AS line FROM lineitem), "
    "f AS (SELECT regr_intercept(y, line) AS a, regr_slope(y, line) AS b FROM x) "
    "SELECT l_returnflag, CAST(count(*) AS BIGINT) AS passed, CAST(count(line) AS BIGINT) AS omitted_rows_kept, round(avg(a + b*line), 4) + 0.0 AS mean_pred FROM x, f GROUP BY 1",
)
def missing_predictors(spark, folder):
    """Pass keeps rows with a missing prediction, omit drops them."""
    from foldspark.operators.missing import predict_rows

    rows = read_table(spark, "lineitem", folder).select(
        "l_returnflag", F.col("l_extendedprice").alias("y"),
        F.nullif("l_linenumber", F.lit(7)).cast("double").alias("line"),
    )
    fitted = Workflow(Recipe.of(rows, "y", ["line"]), linear_reg()).fit(rows)
    passed = predict_rows(fitted, rows, "pass").groupBy("l_returnflag").agg(
        F.count("*").alias("passed"), F.round(F.avg("pred"), 4).alias("mean_pred")
    )
    kept = predict_rows(fitted, rows, "omit").groupBy("l_returnflag").agg(
        F.count("*").alias("omitted_rows_kept")
    )
    return passed.join(kept, "l_returnflag")


@query(
    "i5_tidy_coefficients",
    f"{_STUDENT_X},\nf AS (SELECT regr_intercept(gpa, age) AS a, regr_slope(gpa, age) AS b FROM students WHERE sex = 'F'), "
    "o AS (SELECT regr_intercept(gpa, age) AS a, regr_slope(gpa, age) AS b FROM students WHERE sex = 'O') "
    "SELECT '(Intercept)' AS term, round(f.a, 6) + 0.0 AS estimate FROM f UNION ALL SELECT 'age', round(f.b, 6) + 0.0 FROM f "
    "UNION ALL SELECT 'sex_O', round(o.a - f.a, 6) + 0.0 FROM f, o UNION ALL SELECT 'age_x_sex_O', round(o.b - f.b, 6) + 0.0 FROM f, o",
)
def tidy_interactions(spark, folder):
    """All main effects and the two-way interaction: two separate lines in one model."""
    rows = hold(students(spark, folder).select("gpa", "age", "sex"))
    recipe = formula(rows, "gpa", ["age", "sex"], pairwise=True)
    fit = fit_linear(recipe.prep(rows), rows)
    return fit.tidy(spark).select("term", F.round("estimate", 6).alias("estimate"))


@query(
    "i6_coefficient_covariance",
    f"{_SALES_TRAIN},\n{ols2_sql('train', 'price', 'longitude', 'latitude')}, "
    "c AS (SELECT 0 AS i, 0 AS j, s2*i00 AS v FROM fit UNION ALL SELECT 0, 1, s2*i01 FROM fit UNION ALL SELECT 0, 2, s2*i02 FROM fit UNION ALL "
    "SELECT 1, 0, s2*i01 FROM fit UNION ALL SELECT 1, 1, s2*i11 FROM fit UNION ALL SELECT 1, 2, s2*i12 FROM fit UNION ALL "
    "SELECT 2, 0, s2*i02 FROM fit UNION ALL SELECT 2, 1, s2*i12 FROM fit UNION ALL SELECT 2, 2, s2*i22 FROM fit), "
    "n AS (SELECT unnest([0, 1, 2]) AS k, unnest(['(Intercept)', 'longitude', 'latitude']) AS term) "
    "SELECT a.term AS term_1, b.term AS term_2, round(v * 1000, 6) + 0.0 AS covariance_1000 FROM c JOIN n a ON a.k = i JOIN n b ON b.k = j",
)
def coefficient_covariance(spark, folder):
    train = hold(training(sales_split(spark, folder)))
    recipe = Recipe.of(train, "price", ["longitude", "latitude"])
    table = fit_linear(recipe.prep(train), train).vcov(spark)
    return table.select(
        "term_1", "term_2", F.round(F.col("covariance") * 1000, 6).alias("covariance_1000")
    )


@query(
    "i7_confidence_interval",
    f"WITH c AS (SELECT corr(v, v) AS one, avg(v) AS m, stddev_samp(v)/sqrt(count(*)) AS se, count(*) AS n FROM (SELECT r_regionkey, "
    "sum(o_totalprice)/count(*)/1000 AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey)) "
    # five regions: the 97.5 % quantile of t with 4 degrees of freedom
    "SELECT round(m, 5) + 0.0 AS estimate, round(m - 2.7764451051977987*se, 5) + 0.0 AS conf_low, round(m + 2.7764451051977987*se, 5) + 0.0 AS conf_high FROM c",
)
def confidence_interval(spark, folder):
    """Mean order value over regions, with its t interval."""
    orders = read_table(spark, "orders", folder)
    customer = read_table(spark, "customer", folder)
    nation = read_table(spark, "nation", folder)
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    regions = joined.groupBy("n_regionkey").agg((F.avg("o_totalprice") / 1000).alias("v"))
    fit = fit_linear(formula(regions, "v").prep(regions), regions)
    return rounded(fit.tidy(spark).select("estimate", "conf_low", "conf_high"), 5)


@query(
    "i8_nested_f_test",
    f"{_STUDENT_X},\n{ols2_sql('sx', 'gpa', 'age', 'sex_o')}, "
    "g AS (SELECT sum(r) AS rss_big FROM (SELECT regr_syy(gpa, age) - regr_sxy(gpa, age)*regr_sxy(gpa, age)/regr_sxx(gpa, age) AS r FROM students GROUP BY sex)) "
    "SELECT round(rss, 4) + 0.0 AS rss_small, round(rss_big, 4) + 0.0 AS rss_big, round((rss - rss_big)/(rss_big/(n - 4)), 4) + 0.0 AS statistic FROM fit, g",
)
def nested_models(spark, folder):
    """Main effects against main effects with interaction, from one pass each."""
    rows = hold(students(spark, folder).select("gpa", "age", "sex"))
    small = fit_linear(formula(rows, "gpa", ["age", "sex"]).prep(rows), rows)
    big = fit_linear(formula(rows, "gpa", ["age", "sex"], pairwise=True).prep(rows), rows)
    table = nested_f_test(spark, small, big)
    return table.agg(
        F.round(F.max(F.when(F.col("model") == "small", F.col("rss"))), 4).alias("rss_small"),
        F.round(F.max(F.when(F.col("model") == "big", F.col("rss"))), 4).alias("rss_big"),
        F.round(F.max("statistic"), 4).alias("statistic"),
    )


_LINE_X = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _corr_sql(y: str, x: str, table: str) -> str:
    return (
        f"SELECT '{x}' AS predictor, n, round(r, 6) + 0.0 AS estimate, round(r*sqrt((n-2)/(1-r*r)), 4) + 0.0 AS statistic, n - 2 AS df, "
        f"{_p_sql('r*sqrt((n-2)/(1-r*r))', 'n - 2')} AS p_value, "
        "round(tanh(atanh(r) - 1.959963984540054/sqrt(n-3)), 6) + 0.0 AS conf_low, round(tanh(atanh(r) + 1.959963984540054/sqrt(n-3)), 6) + 0.0 AS conf_high "
        f"FROM (SELECT CAST(count(*) AS BIGINT) AS n, corr({y}, {x}) AS r FROM {table})"
    )


def _rounded_tests(df):
    return df.select(
        "predictor", "n", F.round("estimate", 6).alias("estimate"), F.round("statistic", 4).alias("statistic"), "df",
        F.round("p_value", 3).alias("p_value"), F.round("conf_low", 6).alias("conf_low"), F.round("conf_high", 6).alias("conf_high"),
    )


@query("i9_correlation_test", _corr_sql("l_extendedprice", "l_quantity", "lineitem"))
def one_correlation(spark, folder):
    lines = read_table(spark, "lineitem", folder)
    return _rounded_tests(correlation_p_value(correlation_tests(lines, "l_extendedprice", ["l_quantity"])))


@query("i10_many_correlation_tests", " UNION ALL ".join(_corr_sql("l_extendedprice", x, "lineitem") for x in _LINE_X))
def many_correlations(spark, folder):
    """All predictors against one outcome in a single aggregation."""
    lines = read_table(spark, "lineitem", folder)
    return _rounded_tests(correlation_p_value(correlation_tests(lines, "l_extendedprice", _LINE_X)))


@query(
    "i11_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS term, "
        + ", ".join(
            (f"CAST(NULL AS DOUBLE) AS {b}" if a == b else f"round(corr({min(a, b)}, {max(a, b)}), 6) + 0.0 AS {b}")
            for b in _LINE_X
        )
        + " FROM lineitem"
        for a in _LINE_X
    ),
)
def correlations(spark, folder):
    return rounded(correlation_matrix(read_table(spark, "lineitem", folder), _LINE_X))


@query(
    "i12_paired_t_test",
    "WITH d AS (SELECT l_discount - l_tax AS d FROM lineitem), s AS (SELECT avg(d) AS m, stddev_samp(d)/sqrt(count(*)) AS se, count(*) AS n FROM d) "
    "SELECT CAST(n AS BIGINT) AS n, round(m, 6) + 0.0 AS estimate, round(m/se, 4) + 0.0 AS statistic, CAST(n - 1 AS BIGINT) AS df FROM s",
)
def paired_test(spark, folder):
    from foldspark.operators.correlation import paired_t_test

    lines = read_table(spark, "lineitem", folder)
    table = paired_t_test(lines, "l_discount", "l_tax", t_quantile)
    return table.select("n", F.round("estimate", 6).alias("estimate"), F.round("statistic", 4).alias("statistic"), "df")
