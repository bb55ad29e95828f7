"""Quality scores by co-training a classifier of the text and one of the page's metadata.

The text view sees figures of the text (lengths, repetition, shares of symbols,
capitals and digits); the metadata view sees the source, the language and the
size, never the text. Both are fitted to a bounded sample of labelled rows. Then, round after
round, each labels the unlabelled rows of a second bounded sample that it is
most confident about, and the other one learns from them. Each view is then
calibrated on labelled rows kept aside, a last logistic regression weighs the two
calibrated views, and all documents are scored.

The samples are bounded by ``sample``; computing figures and scores runs as
Spark jobs. The driver holds only sample rows as numbers.

Defined cases: null and empty texts are scored by their (zero) figures; unknown or null
sources and languages count as one unknown value; repeated rows are scored one
by one; labels without a text, or null ones, are not learned from; several labels of one id count as
good only if all are; without labels of both kinds every document gets one score; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldspark.llm.linear_fit import fit_logistic, sigmoid
from foldspark.llm.shared import in_groups, whole

SAMPLE, TRIALS, CONFIDENT, ROUNDS = 20_000, 0.02, 0.9, 4
#: Sources with a column of their own in the metadata view; the others share one.
SOURCES = 200

_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SYMBOLS = re.compile(r"[#*$%&<>{}\[\]^~=_\\/]")


def figures(text: str) -> list[float]:
    """The text view of one text."""
    words = text.split()
    n, size = len(words), max(len(text), 1)
    if not n:
        return [0.0] * 18
    lines = [line for line in text.split("\n") if line.strip()]
    doubled = 1 - len(set(lines)) / max(len(lines), 1)
    distinct = len(set(words)) / n
    in_row = sum(map(str.__eq__, words, words[1:])) / n
    pairs = 1 - len(set(zip(words, words[1:]))) / max(n - 1, 1)
    long = np.log1p(n)
    capitals, symbols = len(_CAPITALS.findall(text)) / size, len(_SYMBOLS.findall(text)) / size
    bars, shouts = text.count("|") / n, text.count("!") / n
    ends = (text.count(".") + text.count(",")) / n
    letters = sum(map(len, words)) / n
    return [
        long,
        long * long / 10,
        float(n < 10),
        distinct,
        distinct * long,
        pairs,
        in_row,
        doubled,
        10 * capitals,
        float(capitals > 0.3),
        10 * symbols,
        float(symbols > 0.02),
        bars,
        float(bars > 0.2),
        shouts,
        ends,
        letters / 10,
        len(lines) / n,
    ]


class Scorer:
    """Both fitted views, their calibration, and the weights that combine them."""

    def __init__(self, sources: list[str], langs: list[str]):
        self.sources, self.langs = {s: i for i, s in enumerate(sources)}, {s: i for i, s in enumerate(langs)}
        self.mean = self.scale = None
        self.text = self.meta = None
        self.calibration = [np.array([1.0, 0.0])] * 2
        self.weights = np.array([1.0, 0.0, 0.0])

    def text_view(self, texts: list[str]) -> np.ndarray:
        """One row of figures per text."""
        return np.array([figures(t or "") for t in texts], float).reshape(len(texts), -1)

    def meta_view(self, sources: list, langs: list, sizes: list) -> np.ndarray:
        """One row of metadata per document."""
        k, m = len(self.sources) + 1, len(self.langs) + 1
        out = np.zeros((len(sources), k + m + 2))
        rows = np.arange(len(sources))
        out[rows, [self.sources.get(s, k - 1) for s in sources]] = 1
        out[rows, [k + self.langs.get(s, m - 1) for s in langs]] = 1
        size = np.log1p(np.array([max(x or 0, 0) for x in sizes], float))
        out[:, -2], out[:, -1] = size / 10, (size / 10) ** 2
        return out

    def scaled(self, figures_: np.ndarray) -> np.ndarray:
        """Figures in standard deviations of the sample."""
        return (figures_ - self.mean) / self.scale

    def views(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Linear scores of the two views, calibrated."""
        raw = [self.scaled(text) @ self.text[:-1] + self.text[-1], meta @ self.meta[:-1] + self.meta[-1]]
        return np.stack([np.clip(x, -30, 30) * c[0] + c[1] for x, c in zip(raw, self.calibration)], axis=1)

    def combined(self, views: np.ndarray) -> np.ndarray:
        """Probability of good quality."""
        return sigmoid(views @ self.weights[:-1] + self.weights[-1])


def co_train(
    scorer: Scorer, text: np.ndarray, meta: np.ndarray, y: np.ndarray, aside: np.ndarray, more_text: np.ndarray, more_meta: np.ndarray,
    rounds: int = ROUNDS,
) -> Scorer:
    """Fit ``scorer``: labelled rows (``aside``: kept for calibration) and unlabelled ones."""
    both = np.concatenate([text, more_text]) if len(more_text) else text
    if not len(both):
        both = np.zeros((1, text.shape[1]))
    scorer.mean, scorer.scale = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-6)
    ridge = 1.0
    learn, own_y = ~aside, y[~aside]
    views, more = [scorer.scaled(text), meta], [scorer.scaled(more_text) if len(more_text) else more_text, more_meta]
    # pseudo-labels each view learns from: rows of the unlabelled sample and their labels, given by the other view
    given: list[dict[int, float]] = [{}, {}]

    def fit(v: int) -> np.ndarray:
        rows = sorted(given[v])
        x = np.concatenate([views[v][learn], more[v][rows]]) if rows else views[v][learn]
        labels = np.concatenate([own_y, [given[v][r] for r in rows]])
        # a pseudo-label counts half
        weight = np.concatenate([np.ones(len(own_y)), np.full(len(rows), 0.5)])
        return fit_logistic(x, labels, ridge, weight)

    models = [fit(0), fit(1)]
    for _ in range(rounds if len(more_text) and len(own_y) and own_y.min() != own_y.max() else 0):
        share = own_y.mean()
        for v in (0, 1):
            prob = sigmoid(more[v] @ models[v][:-1] + models[v][-1])
            order = np.argsort(prob, kind="stable")
            # the most confident of each class, in the proportion of the labels, that the other has not been given
            for label, ranked, amount in ((0.0, order, 1 - share), (1.0, order[::-1], share)):
                sure = prob[ranked] <= 1 - CONFIDENT if label == 0 else prob[ranked] >= CONFIDENT
                fresh = [int(r) for r in ranked[sure] if int(r) not in given[1 - v]]
                for r in fresh[: max(1, int(TRIALS * amount * len(order)))]:
                    given[1 - v][r] = label
        models = [fit(0), fit(1)]
    scorer.text, scorer.meta = models
    held = aside if aside.any() and y[aside].min() != y[aside].max() else np.ones(len(y), bool)
    raw = [views[v] @ models[v][:-1] + models[v][-1] for v in (0, 1)]
    if len(y) and y.min() != y.max():
        scorer.calibration = [fit_logistic(np.clip(r[held], -30, 30)[:, None], y[held], 0.01) for r in raw]
    scorer.weights = fit_logistic(scorer.views(text, meta)[held], y[held], 0.1) if len(y) else np.array([0.0, 0.0, 0.0])
    return scorer


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    source_col: str = "source", lang_col: str = "lang", size_col: str = "n_chars", sample: int = SAMPLE, rounds: int = ROUNDS,
) -> Scorer:
    """A scorer from about ``sample`` labelled and ``sample`` unlabelled rows, those with the smallest hash of the id."""
    rows = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    rows = rows.groupBy(F.col(id_col).alias("_id")).agg(F.min(F.col(label_col).cast("int")).alias("y"))
    share = (F.xxhash64("_id").cast("double") / F.lit(2.0**64)) + 0.5
    meta = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(size_col).cast("long").alias("size"),
        whole(text_col).alias("text"),
    )
    n_labels, n_docs = rows.count(), docs.count()
    near = meta.filter(share < max(sample / max(n_labels, 1), 2 * sample / max(n_docs, 1)))
    near = near.join(rows.filter(share < sample / max(n_labels, 1)), "_id", "left")
    # labelled rows of the sample, and unlabelled rows up to the bound of theirs
    near = near.filter(F.col("y").isNotNull() | (share < sample / max(n_docs, 1)))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_groups(batch, "text"):
                rows_ = [figures(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("_id", "source", "lang", "size", "y")), pa.array(rows_, pa.list_(pa.float64()))],
                    names=["_id", "source", "lang", "size", "y", "figures"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    got = near.mapInArrow(numbers, f"_id {kind}, source string, lang string, size long, y int, figures array<double>")
    # bounded by the samples
    got = got.withColumn("aside", F.crc32(F.col("_id").cast("string").cast("binary")) % 5 == 0).toPandas()
    got = got.sort_values(["_id", "size"], kind="stable")
    known = got["y"].notna().to_numpy()
    sources = got["source"].dropna().value_counts()
    scorer = Scorer(sorted(sources.index[:SOURCES]), sorted(got["lang"].dropna().unique()))
    text = np.array(got["figures"].tolist(), float).reshape(len(got), 18)
    meta_rows = scorer.meta_view(got["source"].tolist(), got["lang"].tolist(), got["size"].fillna(0).tolist())
    return co_train(
        scorer, text[known], meta_rows[known], got["y"][known].to_numpy(float), got["aside"].to_numpy(bool)[known],
        text[~known], meta_rows[~known], rounds,
    )


def score(
    docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    lang_col: str = "lang", size_col: str = "n_chars",
) -> DataFrame:
    """Per row: doc_id, text_score and meta_score (calibrated), score, kept (a score of one half or more)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in in_groups(batch, "text"):
                meta = scorer.meta_view(*(rows.column(c).to_pylist() for c in ("source", "lang", "size")))
                views = scorer.views(scorer.text_view(rows.column("text").to_pylist()), meta)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *(pa.array(x) for x in (sigmoid(views[:, 0]), sigmoid(views[:, 1]), scorer.combined(views)))],
                    names=["doc_id", "text_score", "meta_score", "score"],
                )

    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(size_col).cast("long").alias("size"),
        whole(text_col).alias("text"),
    )
    scored = rows.mapInArrow(run, f"doc_id {kind}, text_score double, meta_score double, score double")
    return scored.withColumn("kept", F.col("score") >= 0.5)
