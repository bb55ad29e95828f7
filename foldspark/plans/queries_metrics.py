"""Queries over metrics, confusion counts and ROC curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldspark.operators.metrics import (
    classification_metrics,
    confusion_matrix,
    performance_report,
    regression_metrics,
    sensitivity,
    sensitivity_by_hand,
)
from foldspark.operators.models import linear_reg
from foldspark.operators.ordered import block_number, positions
from foldspark.operators.recipe import Recipe
from foldspark.operators.resample import testing, training
from foldspark.operators.roc import (
    roc_auc,
    roc_auc_pairwise,
    roc_auc_weighted,
    roc_curve,
    roc_curve_one_vs_all,
)
from foldspark.plans.queries_features import rounded
from foldspark.plans.queries_models import ols2_sql
from foldspark.plans.queries_resample import SALES_SPLIT_SQL, sales_split
from foldspark.plans.registry import query
from foldspark.plans.tables import (
    EVENT_LEVELS,
    GRADED_SQL,
    LABELS_SQL,
    graded_events,
    label_pairs,
)
from foldspark.plans.workflow import Workflow
from foldspark.sources.tables import read_table

PAIR_LEVELS = ["Class1", "Class2"]
SCORES = {k: f"s_{k}" for k in EVENT_LEVELS}

# numeric truth and estimate: the price of a line, and quantity times a flat rate
_NUMERIC = "WITH x AS (SELECT l_returnflag, l_extendedprice / 1000 AS t, l_quantity * 2.1 AS e FROM lineitem)"


def numeric_pairs(spark, folder):
    return read_table(spark, "lineitem", folder).select(
        "l_returnflag", (F.col("l_extendedprice") / 1000).alias("t"), (F.col("l_quantity") * 2.1).alias("e")
    )


_REGRESSION_SQL = {
    "rmse": "sqrt(avg((t - e) * (t - e)))",
    "rsq": "power(corr(t, e), 2)",
    "mae": "avg(abs(t - e))",
}


def _metric_sql(name: str) -> str:
    return f"SELECT '{name}' AS metric, 'standard' AS estimator, round({_REGRESSION_SQL[name]}, 6) + 0.0 AS estimate FROM x"


def _single(name):
    @query(f"y{['rmse', 'rsq', 'mae'].index(name) + 1}_{name}", f"{_NUMERIC} {_metric_sql(name)}")
    def one(spark, folder):
        return rounded(regression_metrics(numeric_pairs(spark, folder), "t", "e", (name,)))

    return one


for _name in _REGRESSION_SQL:
    _single(_name)


@query("y4_metric_set", f"{_NUMERIC} " + " UNION ALL ".join(_metric_sql(m) for m in _REGRESSION_SQL))
def metric_bundle(spark, folder):
    return rounded(regression_metrics(numeric_pairs(spark, folder), "t", "e"))


_EVENTS = f"WITH {GRADED_SQL}"
_PAIRS = f"WITH {LABELS_SQL}"


@query(
    "y5_confusion_matrix",
    f"{_PAIRS}, l AS (SELECT unnest(['Class1', 'Class2']) AS level) SELECT a.level AS truth, b.level AS estimate, "
    "CAST(count(p.doc_id) AS BIGINT) AS n FROM l a CROSS JOIN l b LEFT JOIN pairs p ON p.truth = a.level AND p.predicted = b.level GROUP BY 1, 2",
)
def confusion(spark, folder):
    return confusion_matrix(label_pairs(spark, folder), "truth", "predicted", PAIR_LEVELS)


@query(
    "y5_confusion_matrix_multiclass",
    f"{_EVENTS}, l AS (SELECT unnest({EVENT_LEVELS}) AS level) SELECT a.level AS truth, b.level AS estimate, "
    "CAST(count(p.event_id) AS BIGINT) AS n FROM l a CROSS JOIN l b LEFT JOIN graded p ON p.obs = a.level AND p.pred = b.level GROUP BY 1, 2",
)
def confusion_many(spark, folder):
    return confusion_matrix(graded_events(spark, folder), "obs", "pred", EVENT_LEVELS)


@query(
    "y6_accuracy",
    f"{_PAIRS} SELECT 'accuracy' AS metric, 'binary' AS estimator, round(avg(CAST(truth = predicted AS INTEGER)), 6) + 0.0 AS estimate FROM pairs",
)
def accuracy(spark, folder):
    return rounded(classification_metrics(label_pairs(spark, folder), "truth", "predicted", PAIR_LEVELS, ("accuracy",)))


@query(
    "y6_accuracy_multiclass",
    f"{_EVENTS} SELECT 'accuracy' AS metric, 'multiclass' AS estimator, round(avg(CAST(obs = pred AS INTEGER)), 6) + 0.0 AS estimate FROM graded",
)
def accuracy_many(spark, folder):
    return rounded(classification_metrics(graded_events(spark, folder), "obs", "pred", EVENT_LEVELS, ("accuracy",)))


_BINARY_CELLS = (
    "c AS (SELECT CAST(count(*) FILTER (WHERE truth='Class1' AND predicted='Class1') AS DOUBLE) AS tp, "
    "CAST(count(*) FILTER (WHERE truth='Class2' AND predicted='Class2') AS DOUBLE) AS tn, "
    "CAST(count(*) FILTER (WHERE truth='Class2' AND predicted='Class1') AS DOUBLE) AS fp, "
    "CAST(count(*) FILTER (WHERE truth='Class1' AND predicted='Class2') AS DOUBLE) AS fn FROM pairs)"
)
_MCC = "(tp*tn - fp*fn) / sqrt((tp+fp)*(tp+fn)*(tn+fp)*(tn+fn))"


@query("y7_mcc", f"{_PAIRS}, {_BINARY_CELLS} SELECT 'mcc' AS metric, 'binary' AS estimator, round({_MCC}, 6) + 0.0 AS estimate FROM c")
def matthews(spark, folder):
    return rounded(classification_metrics(label_pairs(spark, folder), "truth", "predicted", PAIR_LEVELS, ("mcc",)))


@query(
    "y7_mcc_multiclass",
    f"{_EVENTS}, t AS (SELECT obs AS k, CAST(count(*) AS DOUBLE) AS t, CAST(count(*) FILTER (WHERE obs = pred) AS DOUBLE) AS h FROM graded GROUP BY 1), "
    "p AS (SELECT pred AS k, CAST(count(*) AS DOUBLE) AS p FROM graded GROUP BY 1), "
    "j AS (SELECT coalesce(t, 0) AS t, coalesce(p, 0) AS p, coalesce(h, 0) AS h FROM t FULL JOIN p ON t.k = p.k), "
    "s AS (SELECT sum(t) AS n, sum(h) AS c, sum(t*p) AS tp, sum(t*t) AS tt, sum(p*p) AS pp FROM j) "
    "SELECT 'mcc' AS metric, 'multiclass' AS estimator, round((c*n - tp)/sqrt((n*n - pp)*(n*n - tt)), 6) + 0.0 AS estimate FROM s",
)
def matthews_many(spark, folder):
    return rounded(classification_metrics(graded_events(spark, folder), "obs", "pred", EVENT_LEVELS, ("mcc",)))


@query(
    "y8_f_measure",
    f"{_PAIRS}, {_BINARY_CELLS} SELECT 'first' AS event_level, round(2*tp/(2*tp + fp + fn), 6) + 0.0 AS estimate FROM c "
    "UNION ALL SELECT 'second', round(2*tn/(2*tn + fp + fn), 6) + 0.0 FROM c",
)
def f_measure(spark, folder):
    """The event is the first or the second level."""
    pairs = label_pairs(spark, folder)
    parts = [
        classification_metrics(pairs, "truth", "predicted", PAIR_LEVELS, ("f_meas",), event_level=side).select(
            F.lit(side).alias("event_level"), "estimate"
        )
        for side in ("first", "second")
    ]
    return rounded(parts[0].unionByName(parts[1]))


@query(
    "y4_class_metric_set",
    f"{_PAIRS}, {_BINARY_CELLS} SELECT 'accuracy' AS metric, 'binary' AS estimator, round((tp+tn)/(tp+tn+fp+fn), 6) + 0.0 AS estimate FROM c "
    f"UNION ALL SELECT 'mcc', 'binary', round({_MCC}, 6) + 0.0 FROM c UNION ALL SELECT 'f_meas', 'binary', round(2*tp/(2*tp+fp+fn), 6) + 0.0 FROM c",
)
def class_bundle(spark, folder):
    return rounded(classification_metrics(label_pairs(spark, folder), "truth", "predicted", PAIR_LEVELS))


_SENS = f"{_EVENTS}, k AS (SELECT obs, count(*) AS t, count(*) FILTER (WHERE obs = pred) AS h FROM graded GROUP BY 1)"


@query(
    "y9_sensitivity",
    f"{_SENS} SELECT 'sensitivity' AS metric, 'macro' AS estimator, round(avg(h / t), 6) + 0.0 AS estimate FROM k "
    "UNION ALL SELECT 'sensitivity', 'macro_weighted', round(sum(h / t * t) / sum(t), 6) + 0.0 FROM k "
    "UNION ALL SELECT 'sensitivity', 'micro', round(sum(h) / sum(t), 6) + 0.0 FROM k",
)
def sensitivities(spark, folder):
    return rounded(sensitivity(graded_events(spark, folder), "obs", "pred"))


@query(
    "y10_sensitivity_by_hand",
    f"{_EVENTS}, cells AS (SELECT obs, pred, count(*) AS n FROM graded GROUP BY 1, 2), "
    "totals AS (SELECT obs, count(*) AS totals, count(*) / (SELECT count(*) FROM graded) AS w FROM graded GROUP BY 1), "
    "j AS (SELECT t.*, n, n / totals AS sens FROM totals t FULL JOIN (SELECT * FROM cells WHERE obs = pred) c ON c.obs = t.obs) "
    "SELECT CASE WHEN count(sens) = count(*) THEN round(avg(sens), 6) + 0.0 END AS macro, "
    "CASE WHEN count(sens) = count(*) THEN round(sum(sens * w) / sum(w), 6) + 0.0 END AS macro_wts, "
    "CASE WHEN count(sens) = count(*) THEN round(sum(n) / sum(totals), 6) + 0.0 END AS micro FROM j",
)
def sensitivity_chain(spark, folder):
    return rounded(sensitivity_by_hand(graded_events(spark, folder), "obs", "pred"))


def _curve_sql(source: str, event: str, score: str, by: str = "") -> str:
    """A curve by running sums over distinct scores, with both open ends."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f"GROUP BY {by}" if by else ""
    join = f"USING ({by})" if by else "ON TRUE"
    return (
        f"g AS (SELECT {keys}{score} AS score, sum(CAST({event} AS INTEGER)) AS pos, sum(1 - CAST({event} AS INTEGER)) AS neg FROM {source} GROUP BY {keys}{score}), "
        f"tot AS (SELECT {keys}sum(pos) AS pp, sum(neg) AS nn FROM g {group}), "
        f"cum AS (SELECT {keys}score, sum(neg) OVER ({part}ORDER BY score) - neg AS below, sum(pos) OVER ({part}ORDER BY score DESC) AS above FROM g) "
        f"SELECT {keys}CAST(NULL AS VARCHAR) AS \"end\", round(score, 6) + 0.0 AS threshold, round(below / nn, 6) + 0.0 AS specificity, round(above / pp, 6) + 0.0 AS sensitivity FROM cum JOIN tot {join} "
        f"UNION ALL SELECT {keys}'-Inf', NULL, 0.0::DOUBLE, 1.0::DOUBLE FROM tot UNION ALL SELECT {keys}'+Inf', NULL, 1.0::DOUBLE, 0.0::DOUBLE FROM tot"
    )


@query("y11_roc_curve", f"{_PAIRS}, {_curve_sql('pairs', chr(39).join(['truth = ', 'Class1', '']), 'score')}")
def curve(spark, folder):
    pairs = label_pairs(spark, folder)
    return rounded(roc_curve(pairs, F.col("truth") == "Class1", F.col("score")))


_AUC = (
    "g AS (SELECT {score} AS score, sum(CAST({event} AS INTEGER)) AS pos, sum(1 - CAST({event} AS INTEGER)) AS neg FROM {source} GROUP BY 1), "
    "c AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score) - neg AS below FROM g) "
    "SELECT round(sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg)), 6) + 0.0 AS estimate FROM c"
)


@query("y12_roc_auc", f"{_PAIRS}, " + _AUC.format(score="score", event="truth = 'Class1'", source="pairs"))
def area(spark, folder):
    pairs = label_pairs(spark, folder)
    return rounded(roc_auc(pairs, F.col("truth") == "Class1", F.col("score")))


@query(
    "y12_roc_auc_many_values",
    "WITH " + _AUC.format(score="l_extendedprice", event="l_quantity > 25", source="lineitem"),
)
def area_many_values(spark, folder):
    """A score with nearly as many values as rows."""
    lines = read_table(spark, "lineitem", folder)
    return rounded(roc_auc(lines, F.col("l_quantity") > 25, F.col("l_extendedprice")))


_LONG_SCORES = (
    "long AS ("
    + " UNION ALL ".join(f"SELECT user_id, '{k}' AS level, obs, round(s_{k}, 6) AS score FROM graded" for k in EVENT_LEVELS)
    + ")"
)


def _rounded_scores(df):
    """Scores at a fixed precision, so that equal sums tie on every engine."""
    return df.withColumns({c: F.round(c, 6) for c in SCORES.values()})


@query(
    "y13_roc_auc_pairwise",
    f"{_EVENTS}, {_LONG_SCORES}, g AS (SELECT level, obs, score, count(*) AS n FROM long GROUP BY 1, 2, 3), "
    "a AS (SELECT level, score, n FROM g WHERE obs = level), b AS (SELECT level, obs, score, n FROM g WHERE obs <> level), "
    "p AS (SELECT a.level, b.obs, sum(a.n * b.n * CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END::DOUBLE) / sum(a.n * b.n) AS auc "
    "FROM a JOIN b ON a.level = b.level GROUP BY 1, 2) SELECT round(avg(auc), 6) + 0.0 AS estimate FROM p",
)
def area_pairwise(spark, folder):
    return rounded(roc_auc_pairwise(_rounded_scores(graded_events(spark, folder)), "obs", SCORES))


@query(
    "y14_roc_auc_weighted",
    f"{_EVENTS}, {_LONG_SCORES}, g AS (SELECT level, score, sum(CAST(obs = level AS INTEGER)) AS pos, sum(1 - CAST(obs = level AS INTEGER)) AS neg FROM long GROUP BY 1, 2), "
    "c AS (SELECT level, pos, neg, sum(neg) OVER (PARTITION BY level ORDER BY score) - neg AS below FROM g), "
    "a AS (SELECT level, sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) AS auc, sum(pos) AS p FROM c GROUP BY 1) "
    "SELECT round(sum(auc * p) / sum(p), 6) + 0.0 AS estimate FROM a",
)
def area_weighted(spark, folder):
    return rounded(roc_auc_weighted(_rounded_scores(graded_events(spark, folder)), "obs", SCORES))


@query(
    "y15_roc_curves_by_group",
    f"{_EVENTS}, {_LONG_SCORES}, blocks AS (SELECT level, obs, score, user_id % 10 AS block FROM long), "
    + _curve_sql("blocks", "obs = level", "score", "block, level"),
)
def curves_by_group(spark, folder):
    """One-versus-all curves of every class in every group."""
    graded = _rounded_scores(graded_events(spark, folder)).withColumn("block", F.col("user_id") % 10)
    return rounded(roc_curve_one_vs_all(graded, "obs", SCORES, ["block"]))


@query(
    "y16_performance_report",
    f"WITH {SALES_SPLIT_SQL},\ntrain AS (SELECT * FROM split WHERE in_train),\n{ols2_sql('train', 'price', 'longitude', 'latitude')}, "
    "x AS (SELECT in_train, price AS t, b0 + b1*longitude + b2*latitude AS e FROM split, fit) "
    "SELECT 'rmse' AS metric, round(sqrt(avg((t-e)*(t-e))), 6) + 0.0 AS estimate, 'lm_fit' AS object, CASE WHEN in_train THEN 'train' ELSE 'test' END AS data FROM x GROUP BY in_train "
    "UNION ALL SELECT 'rsq', round(power(corr(t, e), 2), 6) + 0.0, 'lm_fit', CASE WHEN in_train THEN 'train' ELSE 'test' END FROM x GROUP BY in_train",
)
def report(spark, folder):
    """One labelled report per data set."""
    split = sales_split(spark, folder)
    fitted = Workflow(Recipe.of(split.df, "price", ["longitude", "latitude"]), linear_reg()).fit(training(split))
    sides = {"train": training(split), "test": testing(split)}
    parts = [performance_report(fitted.predict(df), "price", "pred", "lm_fit", name) for name, df in sides.items()]
    return rounded(parts[0].unionByName(parts[1]))


@query(
    "a10_metrics_by_group",
    f"{_EVENTS}, b AS (SELECT *, 'Fold' || lpad(CAST(ntile(10) OVER (ORDER BY event_id) AS VARCHAR), 2, '0') AS resample FROM graded) "
    "SELECT resample, 'accuracy' AS metric, 'multiclass' AS estimator, round(avg(CAST(obs = pred AS INTEGER)), 6) + 0.0 AS estimate FROM b GROUP BY 1",
)
def accuracy_by_block(spark, folder):
    """Accuracy in ten contiguous blocks of the rows."""
    graded = graded_events(spark, folder).select("event_id", "obs", "pred")
    n = graded.count()
    block = block_number(F.col("position"), F.lit(n), 10)
    placed = positions(graded, "event_id").withColumn(
        "resample", F.concat(F.lit("Fold"), F.lpad(block.cast("string"), 2, "0"))
    )
    return rounded(classification_metrics(placed, "obs", "pred", EVENT_LEVELS, ("accuracy",), by=["resample"]))
