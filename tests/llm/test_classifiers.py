import numpy as np
import zlib

from pyspark.sql import functions as F

from foldspark.llm import cotrain, toxicity
from foldspark.llm.linear_fit import fit_logistic, sigmoid


def test_logistic_fit_solves_its_equations():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < sigmoid(x @ np.array([1.0, -2.0, 0.5]) + 0.3)).astype(float)
    beta = fit_logistic(x, y, 0.5)
    gradient = x.T @ (sigmoid(x @ beta[:-1] + beta[-1]) - y) + 0.5 * beta[:-1]
    assert np.abs(gradient).max() < 1e-3
    assert fit_logistic(x, np.ones(400), 0.5)[-1] > 0


def _labels(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet")


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.train(docs, _labels(spark, folder))
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    labels = [r for r in _labels(spark, folder).collect()]
    learned = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5]
    hits = [found[r.doc_id].predicted == r.toxic for r in learned]
    assert np.mean(hits) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    held = [r.doc_id for r in docs.filter(toxicity.held_out("doc_id")).collect()]
    assert sorted(held) == sorted(i for i in found if zlib.crc32(str(i).encode()) % 5 == 0)


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = [(i, "badword here" if i % 2 else "fine here") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    wrong = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [
        {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, x)).collect()} for x in (labels, wrong)
    ]
    assert scores[0] == scores[1]


def test_counterfactuals_lower_the_score_of_neutral_mentions(spark):
    # "muslim" comes with toxic texts only, so a plain fit takes it for a sign of toxicity
    texts = [("the muslim idiot spoke again", 1), ("an idiot spoke", 1), ("the muslim idiot", 1), ("a christian neighbour spoke", 0)]
    texts += [("the neighbour spoke again", 0), ("a walk again", 0)]
    rows = [(k, t, y) for k, (t, y) in enumerate(texts * 60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    neutral = spark.createDataFrame([(1, "a muslim neighbour"), (2, "a jewish neighbour"), (3, "idiot"), (4, None)], "doc_id long, text string")
    plain, tied = (
        {r.doc_id: r for r in toxicity.score(neutral, toxicity.train(docs, labels, tie=tie)).collect()} for tie in (0.0, 10.0)
    )
    assert tied[1].score < plain[1].score
    assert abs(tied[1].score - tied[2].score) < abs(plain[1].score - plain[2].score)
    assert tied[1].predicted == 0 and tied[3].predicted == 1 and tied[4].predicted == 0


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (3, 0), (None, 1), (5, None), (6, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd_docs, labels)
    assert toxicity.score(odd_docs, model).count() == odd_docs.count()
    one = toxicity.score(odd_docs, toxicity.train(odd_docs, labels.filter("toxic = 1"))).collect()
    assert len({r.score for r in one}) == 1
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.score(odd_docs, toxicity.train(no_docs, labels.limit(0))).count() == odd_docs.count()


def test_quality_of_labelled_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {r.doc_id: r for r in cotrain.score(docs, cotrain.train(docs, _labels(spark, folder))).collect()}
    labels = _labels(spark, folder).collect()
    assert np.mean([found[r.doc_id].kept == bool(r.quality) for r in labels]) > 0.97
    assert all(found[r.doc_id].kept for r in labels if r.quality)


def test_a_view_learns_from_the_other():
    rng = np.random.default_rng(5)
    y = (rng.random(60) < 0.5).astype(float)
    truth = (rng.random(3000) < 0.5).astype(float)

    def views(t):
        return np.stack([2 * t - 1 + rng.normal(0, 0.7, len(t)) for _ in range(3)], axis=1)

    few = np.zeros(60, bool)
    few[12:] = True  # the rest only calibrates
    text, meta, more_text, more_meta = views(y), views(y), views(truth), views(truth)
    alone = cotrain.co_train(cotrain.Scorer([], []), text, meta, y, few, more_text, more_meta, rounds=0)
    both = cotrain.co_train(cotrain.Scorer([], []), text, meta, y, few, more_text, more_meta, rounds=6)

    def hits(s):
        return ((s.views(more_text, more_meta) > 0) == truth[:, None].astype(bool)).mean(axis=0).min()

    assert hits(both) >= hits(alone) - 0.005
    score = both.combined(both.views(more_text, more_meta))
    assert ((score > 0.5) == (truth > 0.5)).mean() > 0.97
    # calibrated: the mean score is the share of good rows
    assert abs(score.mean() - truth.mean()) < 0.05


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 0), (3, 1), (None, 1), (5, None), (6, 0)], "doc_id long, quality int")
    scorer = cotrain.train(odd_docs, labels)
    found = cotrain.score(odd_docs, scorer).collect()
    assert len(found) == odd_docs.count() and all(0 <= r.score <= 1 for r in found)
    assert cotrain.score(no_docs, scorer).count() == 0
    assert cotrain.score(odd_docs, cotrain.train(odd_docs, labels.limit(0))).count() == odd_docs.count()
    assert cotrain.score(odd_docs, cotrain.train(no_docs, labels)).count() == odd_docs.count()
