"""Queries over recipe steps: estimated on training rows, applied to all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldspark.operators.recipe import (
    Recipe,
    all_nominal_predictors,
    contains,
    formula,
    model_matrix,
    starts_with,
)
from foldspark.operators.resample import training
from foldspark.plans.queries_resample import SALES_SPLIT_SQL, sales_split
from foldspark.plans.registry import query
from foldspark.plans.tables import STUDENTS_SQL, sales, students
from foldspark.sources.tables import read_table

STYLES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_TRAIN = f"WITH {SALES_SPLIT_SQL}, train AS (SELECT * FROM split WHERE in_train)"


def rounded(df, digits: int = 6):
    """Every double rounded, so that sums in another order compare equal."""
    return df.select(
        *[F.round(f"`{c}`", digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes]
    )


@query(
    "f2_step_log",
    f"WITH {STUDENTS_SQL} SELECT row_key, CASE WHEN age > 0 THEN round(log10(age), 6) + 0.0 END AS age, "
    "CASE WHEN paid_amt + 1 > 0 THEN round(log10(paid_amt + 1), 6) + 0.0 END AS paid_amt FROM students",
)
def step_log(spark, folder):
    rows = students(spark, folder)
    recipe = Recipe.of(rows, "gpa", ["age", "paid_amt"]).step_log("age", base=10)
    recipe = recipe.step_log("paid_amt", base=10, offset=1)
    return rounded(recipe.prep(rows).bake(rows, ["row_key"]))


@query("f3_step_mutate", f"WITH {STUDENTS_SQL} SELECT row_key, left(zip, 1) AS zip FROM students")
def step_mutate(spark, folder):
    rows = students(spark, folder)
    recipe = Recipe.of(rows, "gpa", ["zip"]).step_mutate(zip=lambda c: F.substring(c("zip"), 1, 1))
    return recipe.prep(rows).bake(rows, ["row_key"])


_POOLED = (
    "kept AS (SELECT {c} AS level FROM train GROUP BY 1 HAVING count(*) >= (SELECT count(*) FROM train) * {t})"
)


@query(
    "f4_step_other",
    f"{_TRAIN}, {_POOLED.format(c='district', t=0.04)} "
    "SELECT sale_key, CASE WHEN district IN (SELECT level FROM kept) THEN district ELSE 'other' END AS district FROM split",
)
def step_other(spark, folder):
    """Levels below 4 % of the training rows are pooled everywhere."""
    split = sales_split(spark, folder)
    recipe = Recipe.of(split.df, "price", ["district"]).step_other("district", threshold=0.04)
    return recipe.prep(training(split)).bake(split.df, ["sale_key"])


@query(
    "f5_step_dummy",
    "SELECT o_orderkey AS sale_key, "
    + ", ".join(f"CAST(c_mktsegment = '{s}' AS INTEGER)::DOUBLE AS style_{s}" for s in STYLES[1:])
    + " FROM orders JOIN customer ON o_custkey = c_custkey",
)
def step_dummy(spark, folder):
    rows = sales(spark, folder)
    recipe = Recipe.of(rows, "price", ["style"]).step_dummy(all_nominal_predictors())
    return recipe.prep(rows).bake(rows, ["sale_key"])


@query(
    "f6_step_interact",
    f"{_TRAIN} SELECT sale_key, round(log10(area), 6) + 0.0 AS area, "
    + ", ".join(f"CAST(style = '{s}' AS INTEGER)::DOUBLE AS style_{s}" for s in STYLES[1:])
    + ", "
    + ", ".join(f"round(log10(area) * CAST(style = '{s}' AS INTEGER), 6) + 0.0 AS area_x_style_{s}" for s in STYLES[1:])
    + " FROM split",
)
def step_interact(spark, folder):
    """Products of a logged number with the dummies of a nominal column."""
    split = sales_split(spark, folder)
    recipe = (
        Recipe.of(split.df, "price", ["area", "style"])
        .step_log("area", base=10)
        .step_dummy(all_nominal_predictors())
        .step_interact("area", starts_with("style_"))
    )
    return rounded(recipe.prep(training(split)).bake(split.df, ["sale_key"]))


_NS_FIT = """
k AS (SELECT min(area) AS k0, quantile_cont(area, 0.5) AS k1, max(area) AS k2 FROM train),
cube AS (SELECT sale_key, in_train, price, area AS x1,
  (power(greatest(area - k0, 0), 3) - power(greatest(area - k2, 0), 3)) / (k2 - k0)
  - (power(greatest(area - k1, 0), 3) - power(greatest(area - k2, 0), 3)) / (k2 - k1) AS raw FROM split, k),
scaled AS (SELECT c.*, raw / (SELECT max(abs(raw)) FROM cube) AS x2 FROM cube c)"""


@query(
    "f7_step_ns",
    f"{_TRAIN},{_NS_FIT}, "
    "m AS (SELECT avg(price) AS my, avg(x1) AS m1, avg(x2) AS m2 FROM scaled WHERE in_train), "
    "s AS (SELECT sum((x1-m1)*(x1-m1)) AS s11, sum((x2-m2)*(x2-m2)) AS s22, sum((x1-m1)*(x2-m2)) AS s12, "
    "sum((x1-m1)*(price-my)) AS s1y, sum((x2-m2)*(price-my)) AS s2y FROM scaled, m WHERE in_train), "
    "b AS (SELECT (s22*s1y - s12*s2y)/(s11*s22 - s12*s12) AS b1, (s11*s2y - s12*s1y)/(s11*s22 - s12*s12) AS b2 FROM s) "
    "SELECT sale_key, round(my + b1*(x1-m1) + b2*(x2-m2), 6) + 0.0 AS pred FROM scaled, m, b",
)
def step_ns(spark, folder):
    """Two natural-spline terms; the fitted curve does not depend on the basis chosen."""
    from foldspark.operators.models import linear_reg
    from foldspark.plans.workflow import Workflow

    split = sales_split(spark, folder)
    recipe = Recipe.of(split.df, "price", ["area"]).step_ns("area", deg_free=2)
    fitted = Workflow(recipe, linear_reg()).fit(training(split))
    return rounded(fitted.predict(split.df).select("sale_key", "pred"))


@query(
    "f8_step_normalize",
    f"{_TRAIN}, m AS (SELECT avg(area) AS ma, stddev_samp(area) AS sa, avg(latitude) AS ml, stddev_samp(latitude) AS sl FROM train) "
    "SELECT sale_key, round((area - ma) / sa, 6) + 0.0 AS area, round((latitude - ml) / sl, 6) + 0.0 AS latitude FROM split, m",
)
def step_normalize(spark, folder):
    split = sales_split(spark, folder)
    recipe = Recipe.of(split.df, "price", ["area", "latitude"]).step_normalize("area", "latitude")
    return rounded(recipe.prep(training(split)).bake(split.df, ["sale_key"]))


@query("f9_step_pca")
def step_pca(spark, folder):
    """Components of the embedding that reach 95 % of the variance."""
    vectors = read_table(spark, "embeddings", folder)
    sizes = vectors.agg(F.min(F.size("embedding")).alias("least"), F.max(F.size("embedding")).alias("most")).first()
    if sizes.least != sizes.most:
        raise ValueError(f"embeddings have {sizes.least} to {sizes.most} numbers")
    width = sizes.most
    names = [f"SF_{i:02d}" for i in range(width)]
    rows = vectors.select(
        "vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)]
    )
    recipe = (
        Recipe.of(rows, "label", names).step_normalize(contains("SF")).step_pca(contains("SF"), threshold=0.95)
    )
    return rounded(recipe.prep(rows).bake(rows, ["vec_id", "label"]))


@query(
    "f9_pca_variance",
    "WITH x AS (SELECT l_quantity AS a, l_discount AS b FROM lineitem), "
    "r AS (SELECT abs(corr(a, b)) AS r FROM x) "
    "SELECT 'PC1' AS component, round((1 + r) / 2, 6) + 0.0 AS share FROM r UNION ALL SELECT 'PC2', round(1.0::DOUBLE, 6) + 0.0 FROM r",
)
def pca_variance(spark, folder):
    """Two standardised columns: the shares of variance follow from their correlation."""
    lines = read_table(spark, "lineitem", folder).select("l_quantity", "l_discount", "l_tax")
    recipe = (
        Recipe.of(lines, "l_tax", ["l_quantity", "l_discount"])
        .step_normalize("l_quantity", "l_discount")
        .step_pca("l_quantity", "l_discount", threshold=0.95)
    )
    share = recipe.prep(lines).learned[1]["share"]
    rows = [(f"PC{i}", float(s)) for i, s in enumerate(share, start=1)]
    return rounded(spark.createDataFrame(rows, "component string, share double"))


@query("f10_step_rm", f"WITH {STUDENTS_SQL} SELECT row_key, age, sex FROM students")
def step_rm(spark, folder):
    rows = students(spark, folder)
    recipe = Recipe.of(rows, "gpa", ["age", "sex", "retained", "band"]).step_rm("retained", "band")
    return recipe.prep(rows).bake(rows, ["row_key"])


@query(
    "f11_update_role",
    f"WITH {STUDENTS_SQL} SELECT term, CAST(count(*) AS BIGINT) AS n FROM students, (SELECT unnest(['age', 'day_hours']) AS term) GROUP BY 1",
)
def update_role(spark, folder):
    """An identifier stays in the table but out of the design."""
    rows = students(spark, folder)
    recipe = Recipe.of(rows, "gpa", ["age", "day_hours", "person_id"])
    prepared = recipe.update_role("person_id", new_role="identifier").prep(rows)
    terms = F.explode(F.array(*[F.lit(t) for t in prepared.terms])).alias("term")
    kept = rows.where(F.size(prepared.design()) == len(prepared.terms))
    return kept.select(terms).groupBy("term").agg(F.count("*").alias("n"))


@query(
    "f12_tidy_step",
    f"{_TRAIN}, {_POOLED.format(c='district', t=0.04)} SELECT 'district' AS terms, level AS value, 'my_id' AS id FROM kept",
)
def tidy_step(spark, folder):
    """The retained levels of a step, looked up by its id."""
    split = sales_split(spark, folder)
    recipe = (
        Recipe.of(split.df, "price", ["district", "area"])
        .step_log("area", base=10)
        .step_other("district", threshold=0.04, id="my_id")
        .step_dummy(all_nominal_predictors())
    )
    return recipe.prep(training(split)).tidy(spark, id="my_id")


@query(
    "f16_model_matrix",
    f"WITH {STUDENTS_SQL} SELECT row_key, 1.0::DOUBLE AS intercept, age, CAST(sex = 'O' AS INTEGER)::DOUBLE AS sex_O, "
    "age * CAST(sex = 'O' AS INTEGER) AS age_x_sex_O FROM students",
)
def design_matrix(spark, folder):
    rows = students(spark, folder)
    return model_matrix(rows, formula(rows, "gpa", ["age", "sex"], pairwise=True), ["row_key"])
