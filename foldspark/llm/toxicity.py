"""Toxicity by a counterfactually regularised classifier.

The classifier is a logistic regression on the words of a text and on their
beginnings (4 to 6 letters). It is fitted to a bounded sample of labelled rows.
For every labelled text with an identity term, the text is also taken with its
identity terms swapped for others of the same group, and a change of the score
between the two is penalised: naming a group must not by itself make a text
toxic. Words for which the sample shows the clearest difference between the
labels are features, and the identity terms always are, so that the penalty can act on them.

Sample and features are bounded by ``sample`` and ``features``; counting words and scoring run as
Spark jobs over the sample and over all texts.

Defined cases: null and empty texts get the score of a text without known words;
repeated rows are scored one by one; several labels of one id count as toxic if one is;
labels without a text, or null ones, are not learned from; without labels of both kinds every text gets one score;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldspark.llm.linear_fit import fit_logistic, sigmoid
from foldspark.llm.shared import checkpoint, in_groups, whole

#: fixed values: identity terms by group; a swap stays within a group
IDENTITY = [
    "man woman men women male female boy girl transgender nonbinary".split(),
    "christian muslim jewish jew hindu buddhist sikh atheist catholic protestant".split(),
    "black white asian african european latino hispanic arab indigenous".split(),
    "gay lesbian bisexual straight heterosexual homosexual queer".split(),
    "american mexican chinese indian german french spanish russian turkish polish immigrant refugee".split(),
    "young old elderly teenage".split(),
    "disabled blind deaf autistic".split(),
]
_SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY for i, term in enumerate(group)}
_WORD = re.compile(r"\w+")
SAMPLE, FEATURES = 20_000, 400
#: Features counted in a task before their counts are handed on.
COUNTED = 150_000
RIDGE, TIE = 0.01, 10.0


def features_of(word: str) -> list[str]:
    """A word's features: itself, and its beginnings with a star behind."""
    return [word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) > n)]


def _known(piece: str) -> list[str]:
    return [f for word in _WORD.findall(piece.lower()) for f in features_of(word)]


def held_out(id_col: str) -> Column:
    """Rows labels are never learned from: crc32 of the id as text, divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """About ``sample`` labelled texts (all, if fewer), those with the smallest hash of the id: text, y."""
    rows = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    rows = rows.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    total = rows.count()
    if total > sample:
        # hash of the id as a share of its range
        share = (F.xxhash64("_id").cast("double") / F.lit(2.0**64)) + 0.5
        rows = rows.filter(share < sample / total)
    texts = docs.select(F.col(id_col).alias("_id"), whole(text_col).alias("text"))
    return texts.join(rows, "_id").select("text", "y")


def _contrasts(rows: DataFrame, features: int, least: int = 3) -> list[str]:
    """The features whose share of toxic and of other texts differs most, in standard errors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: dict[str, int] = {}
        other: dict[str, int] = {}

        def counted() -> pa.RecordBatch:
            names = list(toxic.keys() | other.keys())
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array([toxic.get(f, 0) for f in names], pa.int64()),
                    pa.array([other.get(f, 0) for f in names], pa.int64()),
                ],
                names=["feature", "toxic", "other"],
            )
            toxic.clear()
            other.clear()
            return out

        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                table = toxic if y else other
                for f in set(_known(text)):
                    table[f] = table.get(f, 0) + 1
                # partial counts are added up afterwards
                if len(toxic) + len(other) > COUNTED:
                    yield counted()
        yield counted()

    size = rows.agg(F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    n1, n0 = size.toxic or 0, (size.n or 0) - (size.toxic or 0)
    if not n1 or not n0:
        return []
    counts = rows.mapInArrow(count, "feature string, toxic long, other long")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b")).filter(f"a + b >= {least}")
    share = (F.col("a") + F.col("b") + 1) / (n1 + n0 + 2)
    z = (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    counts = counts.withColumn("z", z)
    chosen = counts.orderBy(F.desc("z"), "feature").limit(features)
    return [r.feature for r in chosen.select("feature").collect()]


class Model:
    """Weights by feature; ``score`` gives the probability of a toxic text."""

    def __init__(self, names: list[str], weights: np.ndarray):
        self.place = {f: i for i, f in enumerate(names)}
        self.weights = weights
        self._hits: dict[str, tuple[int, ...]] = {}

    def hits(self, piece: str) -> tuple[int, ...]:
        """Numbers of the features that a piece of text has."""
        found = self._hits.get(piece)
        if found is None:
            if len(self._hits) > 100_000:
                self._hits.clear()
            found = tuple({self.place[f] for f in _known(piece) if f in self.place})
            if len(piece) <= 64:
                self._hits[piece] = found
        return found

    def of_batch(self, texts: pa.Array) -> list[set[int]]:
        """The features of each text."""
        clean = pc.replace_substring_regex(pc.fill_null(texts, ""), r"[\x09-\x0D]", " ").cast(pa.large_string())
        lists = pc.split_pattern(clean, " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        hits = [self.hits(p) for p in coded.dictionary.to_pylist()]
        has = np.fromiter(map(bool, hits), bool, len(hits))
        index = coded.indices.to_numpy(zero_copy_only=False)
        at = np.flatnonzero(has[index]) if len(index) else np.empty(0, np.int64)
        doc = np.repeat(np.arange(len(counts)), counts)[at]
        out: list[set[int]] = [set() for _ in range(len(counts))]
        for d, i in zip(doc.tolist(), index[at].tolist()):
            out[d].update(hits[i])
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of each text being toxic."""
        constant = self.weights[-1]
        return sigmoid(np.array([constant + sum(self.weights[i] for i in sorted(s)) for s in self.of_batch(texts)], float))


def swapped(text: str) -> str:
    """The text with each identity term replaced by the next of its group."""
    return _WORD.sub(lambda m: _SWAP.get(m[0].lower(), m[0]), text)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    features: int = FEATURES,
    ridge: float = RIDGE,
    tie: float = TIE,
) -> Model:
    """A model fitted to about ``sample`` labelled rows with up to ``features`` learned features."""
    rows = checkpoint(labelled_sample(docs, labels, id_col, text_col, label_col, sample).repartition("text"))
    names = sorted({*_contrasts(rows, features), *(f for group in IDENTITY for term in group for f in features_of(term))})
    shell = Model(names, np.zeros(len(names) + 1))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_groups(batch, "text"):
                own = shell.of_batch(part.column("text"))
                others = [swapped(t) for t in part.column("text").to_pylist()]
                other = shell.of_batch(pa.array(others, pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("y"),
                        pa.array([sorted(s) for s in own], pa.list_(pa.int32())),
                        pa.array([sorted(s) for s in other], pa.list_(pa.int32())),
                    ],
                    names=["y", "own", "other"],
                )

    # bounded by the sample: a few numbers a row
    found = rows.mapInArrow(vectors, "y int, own array<int>, other array<int>").toPandas()

    def matrix(lists) -> np.ndarray:
        out = np.zeros((len(lists), len(names)), np.float32)
        for i, own in enumerate(lists):
            out[i, list(own)] = 1
        return out

    x, other = matrix(found["own"]), matrix(found["other"])
    changed = (x != other).any(axis=1) if len(x) else np.empty(0, bool)
    weights = fit_logistic(x, found["y"].to_numpy(float), ridge, same=(x - other)[changed], tie=tie)
    return Model(names, weights)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score (0 to 1), predicted (1 from a score of one half)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in in_groups(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(model.score(rows.column("text")))], names=["doc_id", "score"]
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    scored = rows.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
