"""Queries over splits and resamples: every random choice is a row hash."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldspark.operators.ordered import positions
from foldspark.operators.resample import (
    bootstraps,
    initial_split,
    mc_cv,
    rolling_origin,
    testing,
    training,
    validation_split,
    vfold_cv,
)
from foldspark.plans.queries_tables import hash_sql
from foldspark.plans.registry import query
from foldspark.plans.tables import SALES_SQL, STUDENTS_SQL, sales, students
from foldspark.session import hold
from foldspark.sources.tables import read_table

SPLIT_SEED, STRATA_SEED, FOLD_SEED, PROP = 501, 502, 1001, 0.8


def split_sql(source: str, key: str, prop: float = PROP, seed=SPLIT_SEED, name: str = "split") -> str:
    """A table with ``in_train``: the first floor(n * prop) rows in hash order."""
    return (
        f"{name} AS (SELECT *, row_number() OVER (ORDER BY {hash_sql(seed, key)}) "
        f"<= floor(count(*) OVER () * {prop}) AS in_train FROM {source})"
    )


def strata_split_sql(source: str, key: str, y: str, prop: float = PROP, seed=STRATA_SEED, name: str = "split") -> str:
    """The same in every quartile bin of y."""
    return (
        f"{name}_breaks AS (SELECT quantile_cont({y}, 0.25) AS q1, quantile_cont({y}, 0.5) AS q2, quantile_cont({y}, 0.75) AS q3 FROM {source}),\n"
        f"{name}_bins AS (SELECT s.*, 1 + ({y} > q1)::INT + ({y} > q2)::INT + ({y} > q3)::INT AS bin FROM {source} s, {name}_breaks),\n"
        f"{name} AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY {hash_sql(seed, key)}) "
        f"<= floor(count(*) OVER (PARTITION BY bin) * {prop}) AS in_train FROM {name}_bins)"
    )


def folds_sql(source: str, key: str, v: int = 10, seed=FOLD_SEED, name: str = "folds") -> str:
    """A table with ``fold``: equal contiguous runs in hash order."""
    return f"{name} AS (SELECT *, ntile({v}) OVER (ORDER BY {hash_sql(seed, key)}) AS fold FROM {source})"


def sales_split(spark, folder):
    return initial_split(hold(sales(spark, folder)), "sale_key", PROP, strata="price", seed=STRATA_SEED)


SALES_SPLIT_SQL = f"{SALES_SQL},\n{strata_split_sql('sales', 'sale_key', 'price')}"


@query(
    "r1_initial_split",
    f"WITH {split_sql('orders', 'o_orderkey')} SELECT o_orderkey, CASE WHEN in_train THEN 'training' ELSE 'testing' END AS role FROM split",
)
def random_split(spark, folder):
    split = initial_split(read_table(spark, "orders", folder), "o_orderkey", PROP, seed=SPLIT_SEED)
    return split.labelled().select("o_orderkey", "role")


@query(
    "r2_stratified_split",
    f"WITH {SALES_SPLIT_SQL} SELECT sale_key, CASE WHEN in_train THEN 'training' ELSE 'testing' END AS role FROM split",
)
def stratified_split(spark, folder):
    return sales_split(spark, folder).labelled().select("sale_key", "role")


@query(
    "r2_stratified_split_students",
    f"WITH {STUDENTS_SQL},\n{strata_split_sql('students', 'row_key', 'gpa')} "
    "SELECT CASE WHEN in_train THEN 'training' ELSE 'testing' END AS role, CAST(count(*) AS BIGINT) AS n, round(avg(row_key), 4) + 0.0 AS mean_key FROM split GROUP BY 1",
)
def stratified_split_students(spark, folder):
    rows = students(spark, folder).select("row_key", "gpa")
    split = initial_split(rows, "row_key", PROP, strata="gpa", seed=STRATA_SEED)
    return split.labelled().groupBy("role").agg(F.count("*").alias("n"), F.round(F.avg("row_key"), 4).alias("mean_key"))


@query(
    "r3_training_and_testing",
    f"WITH {SALES_SPLIT_SQL} SELECT CASE WHEN in_train THEN 'training' ELSE 'testing' END AS side, CAST(count(*) AS BIGINT) AS n, "
    "round(avg(price), 6) + 0.0 AS price FROM split GROUP BY 1",
)
def split_sides(spark, folder):
    split = sales_split(spark, folder)
    frames = {"training": training(split), "testing": testing(split)}
    parts = [
        df.agg(F.lit(side).alias("side"), F.count("*").alias("n"), F.round(F.avg("price"), 6).alias("price"))
        for side, df in frames.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "r4_vfold",
    f"WITH {folds_sql('orders', 'o_orderkey')} SELECT o_orderkey, CAST(fold AS INTEGER) AS fold FROM folds",
)
def vfold(spark, folder):
    folds = vfold_cv(read_table(spark, "orders", folder), "o_orderkey", 10, seed=FOLD_SEED)
    return folds.df.select("o_orderkey", folds.fold.alias("fold"))


_REPEATS = " UNION ALL ".join(
    f"SELECT 'Repeat{r}' AS repeat, o_orderkey, ntile(10) OVER (ORDER BY {hash_sql(FOLD_SEED if r == 1 else f'{FOLD_SEED}.{r}', 'o_orderkey')}) AS fold FROM orders"
    for r in range(1, 6)
)


@query(
    "r5_repeated_vfold",
    f"WITH m AS ({_REPEATS}) SELECT repeat || '_Fold' || lpad(CAST(fold AS VARCHAR), 2, '0') AS id, o_orderkey AS \"row\", 'assessment' AS role, CAST(1 AS BIGINT) AS times FROM m",
)
def repeated_vfold(spark, folder):
    """Assessment membership of all 50 resamples; the analysis side is its complement."""
    folds = vfold_cv(read_table(spark, "orders", folder), "o_orderkey", 10, repeats=5, seed=FOLD_SEED)
    return folds.assessment_membership()


_MONTE_CARLO = " UNION ALL ".join(
    f"SELECT 'Resample{i:02d}' AS id, o_orderkey, row_number() OVER (ORDER BY {hash_sql(f'7.{i}', 'o_orderkey')}) <= floor(count(*) OVER () * 0.9) AS a FROM orders"
    for i in range(1, 21)
)


@query(
    "r6_monte_carlo",
    f"WITH m AS ({_MONTE_CARLO}) SELECT id, CASE WHEN a THEN 'analysis' ELSE 'assessment' END AS role, CAST(count(*) AS BIGINT) AS n, round(avg(o_orderkey), 4) + 0.0 AS mean_key FROM m GROUP BY 1, 2",
)
def monte_carlo(spark, folder):
    resamples = mc_cv(read_table(spark, "orders", folder), "o_orderkey", 0.9, times=20, seed=7)
    return resamples.membership().groupBy("id", "role").agg(
        F.sum("times").alias("n"), F.round(F.avg("row"), 4).alias("mean_key")
    )


@query(
    "r7_validation_split",
    f"WITH {split_sql('orders', 'o_orderkey', 0.75, 1002)} SELECT o_orderkey AS \"row\", 'validation' AS id, CASE WHEN in_train THEN 'analysis' ELSE 'assessment' END AS role, CAST(1 AS BIGINT) AS times FROM split",
)
def single_validation(spark, folder):
    return validation_split(read_table(spark, "orders", folder), "o_orderkey", 0.75, seed=1002).membership()


_DRAWS = " UNION ALL ".join(
    f"SELECT 'Bootstrap{b:02d}' AS id, CAST(floor({hash_sql(f'3.{b}', 'i')} / 4503599627370496.0 * n) AS BIGINT) + 1 AS position FROM r, size"
    for b in range(1, 6)
)


@query(
    "r8_bootstraps",
    "WITH size AS (SELECT count(*) AS n FROM orders), r AS (SELECT unnest(range(0, n)) AS i FROM size), "
    f"draws AS ({_DRAWS}), placed AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS position FROM orders), "
    "times AS (SELECT id, position, count(*) AS times FROM draws GROUP BY 1, 2), "
    "ids AS (SELECT DISTINCT id FROM draws) "
    "SELECT i.id, p.o_orderkey AS \"row\", CASE WHEN t.times IS NULL THEN 'assessment' ELSE 'analysis' END AS role, CAST(coalesce(t.times, 1) AS BIGINT) AS times "
    "FROM placed p CROSS JOIN ids i LEFT JOIN times t ON t.id = i.id AND t.position = p.position",
)
def bootstrap_sets(spark, folder):
    orders = read_table(spark, "orders", folder).select("o_orderkey")
    return bootstraps(orders, "o_orderkey", times=5, seed=3).membership()


@query(
    "r9_rolling_origin",
    "WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), "
    "p AS (SELECT day, row_number() OVER (ORDER BY day) AS position FROM days), "
    "e AS (SELECT event_id, value, position FROM events JOIN p ON CAST(ts AS DATE) = day), "
    "n AS (SELECT max(position) AS n FROM e), "
    "s AS (SELECT unnest(range(0, (n - 14 - 4) // 3 + 1)) AS k FROM n) "
    "SELECT CAST(k + 1 AS BIGINT) AS slice, CASE WHEN position - 3 * k <= 14 THEN 'analysis' ELSE 'assessment' END AS role, "
    "min(position) AS first, max(position) AS last, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) + 0.0 AS total "
    "FROM e JOIN s ON position BETWEEN 3 * k + 1 AND 3 * k + 18 GROUP BY 1, 2",
)
def rolling_days(spark, folder):
    """Fourteen days of events predict the next four, moving three days at a time."""
    events = read_table(spark, "events", folder).select("value", F.to_date("ts").alias("day"))
    days = positions(
        events.select(F.unix_date("day").cast("long").alias("day_number")).distinct(), "day_number"
    )
    placed = events.withColumn("day_number", F.unix_date("day").cast("long")).join(days, "day_number")
    slices = rolling_origin(placed.select("value", "position"), "position", initial=14, assess=4, skip=2)
    return slices.groupBy("slice", "role").agg(
        F.min("position").alias("first"), F.max("position").alias("last"),
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"),
    )


@query(
    "r10_analysis_and_assessment",
    f"WITH {folds_sql('orders', 'o_orderkey')} SELECT CASE WHEN fold <> 1 THEN 'analysis' ELSE 'assessment' END AS role, "
    "CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 2) + 0.0 AS total FROM folds GROUP BY 1",
)
def first_fold(spark, folder):
    folds = vfold_cv(read_table(spark, "orders", folder), "o_orderkey", 10, seed=FOLD_SEED)

    def summary(df, role):
        return df.agg(
            F.lit(role).alias("role"), F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
        )

    return summary(folds.analysis("Fold01"), "analysis").unionByName(
        summary(folds.assessment("Fold01"), "assessment")
    )
