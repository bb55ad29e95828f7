"""Metrics and ROC curves against brute force."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from foldspark.operators.metrics import (
    classification_metrics,
    confusion_matrix,
    performance_report,
    regression_metrics,
    sensitivity,
    sensitivity_by_hand,
    summarize_metrics,
)
from foldspark.operators.roc import (
    roc_auc,
    roc_auc_pairwise,
    roc_auc_weighted,
    roc_curve,
    roc_curve_one_vs_all,
)


def _pair_area(pos, neg):
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def tied(spark):
    rows = [("yes", 0.9), ("yes", 0.5), ("no", 0.5), ("no", 0.5), ("yes", 0.7), ("no", 0.1), ("yes", 0.1), ("no", 0.9)]
    return spark.createDataFrame(rows, "truth string, score double")


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        truth = "abc"[rng.choice(3, p=[0.6, 0.3, 0.1])]
        scores = np.round(rng.random(3) + 0.4 * np.array([truth == c for c in "abc"]), 1)
        rows.append((i, truth, "abc"[int(scores.argmax())], *map(float, scores), f"f{i % 2}"))
    return spark.createDataFrame(rows, "id long, obs string, pred string, a double, b double, c double, fold string").persist()


def test_area_with_ties(tied):
    rows = tied.collect()
    want = _pair_area([r["score"] for r in rows if r["truth"] == "yes"], [r["score"] for r in rows if r["truth"] == "no"])
    assert roc_auc(tied, F.col("truth") == "yes", F.col("score")).first()[0] == pytest.approx(want)
    # the other level as the event mirrors the area
    assert roc_auc(tied, F.col("truth") == "no", F.col("score")).first()[0] == pytest.approx(1 - want)


@given(st.lists(st.tuples(st.booleans(), st.integers(0, 6)), min_size=4, max_size=30))
@settings(max_examples=5, deadline=None)
def test_area_property(spark, rows):
    pos, neg = [s for t, s in rows if t], [s for t, s in rows if not t]
    df = spark.createDataFrame([(bool(t), float(s)) for t, s in rows], "t boolean, s double")
    got = roc_auc(df, F.col("t"), F.col("s")).first()[0]
    assert got is None if not pos or not neg else got == pytest.approx(_pair_area(pos, neg))


def test_curve_points_and_ends(tied):
    rows = roc_curve(tied, F.col("truth") == "yes", F.col("score")).collect()
    assert {r["end"] for r in rows} == {None, "-Inf", "+Inf"} and len(rows) == 6
    at = {r["threshold"]: (r["specificity"], r["sensitivity"]) for r in rows if r["end"] is None}
    assert at[0.5] == (pytest.approx(0.25), pytest.approx(0.75)) and at[0.9] == (pytest.approx(0.75), pytest.approx(0.25))


def test_multiclass_areas(classes):
    rows = classes.collect()
    by = {c: [r for r in rows if r["obs"] == c] for c in "abc"}
    pairs = [
        (_pair_area([r[j] for r in by[j]], [r[j] for r in by[k]]) + _pair_area([r[k] for r in by[k]], [r[k] for r in by[j]])) / 2
        for j, k in itertools.combinations("abc", 2)
    ]
    scores = {c: c for c in "abc"}
    assert roc_auc_pairwise(classes, "obs", scores).first()[0] == pytest.approx(np.mean(pairs))
    one = [_pair_area([r[c] for r in by[c]], [r[c] for r in rows if r["obs"] != c]) for c in "abc"]
    want = np.average(one, weights=[len(by[c]) for c in "abc"])
    assert roc_auc_weighted(classes, "obs", scores).first()[0] == pytest.approx(want)
    curves = roc_curve_one_vs_all(classes, "obs", scores, ["fold"])
    assert curves.select("fold", "level").distinct().count() == 6


def test_sensitivity_by_hand_agrees(classes):
    got = {r["estimator"]: r["estimate"] for r in sensitivity(classes, "obs", "pred").collect()}
    hand = sensitivity_by_hand(classes, "obs", "pred").first()
    assert got["macro"] == pytest.approx(hand["macro"])
    assert got["macro_weighted"] == pytest.approx(hand["macro_wts"]) and got["micro"] == pytest.approx(hand["micro"])


def test_class_never_predicted_right(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("c", "b")]
    df = spark.createDataFrame(rows, "obs string, pred string")
    got = {r["estimator"]: r["estimate"] for r in sensitivity(df, "obs", "pred").collect()}
    assert got["macro"] == pytest.approx((0.5 + 1 + 0) / 3)
    assert sensitivity_by_hand(df, "obs", "pred").first()["macro"] is None


def test_confusion_keeps_empty_cells(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "t string, e string")
    cells = {(r["truth"], r["estimate"]): r["n"] for r in confusion_matrix(df, "t", "e", ["a", "b", "c"]).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 2 and cells["c", "c"] == 0


def test_event_level_swaps_the_roles(tied):
    df = tied.withColumn("guess", F.when(F.col("score") > 0.5, "yes").otherwise("no"))

    def f(levels, side):
        return classification_metrics(df, "truth", "guess", levels, ("f_meas",), event_level=side).first()["estimate"]

    assert f(["yes", "no"], "first") == f(["no", "yes"], "second") != f(["yes", "no"], "second")
    with pytest.raises(ValueError):
        classification_metrics(df, "truth", "guess", ["a", "b", "c"])


def test_bundle_equals_single_metrics(classes):
    both = {r["metric"]: r["estimate"] for r in classification_metrics(classes, "obs", "pred", ["a", "b", "c"], ("accuracy", "mcc")).collect()}
    for m in both:
        assert classification_metrics(classes, "obs", "pred", ["a", "b", "c"], (m,)).first()["estimate"] == both[m]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5, "g"), (2.0, 1.5, "g"), (4.0, 4.5, "g"), (3.0, None, "g")], "t double, e double, g string")
    got = {r["metric"]: r["estimate"] for r in regression_metrics(df, "t", "e", by=["g"]).collect()}
    assert got["rmse"] == pytest.approx(0.5) and got["mae"] == pytest.approx(0.5)
    assert got["rsq"] == pytest.approx(np.corrcoef([1, 2, 4], [1.5, 1.5, 4.5])[0, 1] ** 2)
    flat = df.withColumn("e", F.lit(2.0))
    assert {r["metric"]: r["estimate"] for r in regression_metrics(flat, "t", "e").collect()}["rsq"] is None
    report = performance_report(df, "t", "e", "lm", "test").collect()
    assert {r["metric"] for r in report} == {"rmse", "rsq"} and report[0]["object"] == "lm"


def test_summary_over_resamples(spark):
    df = spark.createDataFrame([("f1", "rmse", "standard", 1.0), ("f2", "rmse", "standard", 3.0)], "id string, metric string, estimator string, estimate double")
    row = summarize_metrics(df).first()
    assert (row["mean"], row["n"]) == (2.0, 2) and row["std_err"] == pytest.approx(1.0)
