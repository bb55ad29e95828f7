import math

import numpy as np
import pytest

from foldspark.llm import whitening


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
def test_inertia_counts_positive_eigenvalues(n):
    rng = np.random.default_rng(n)
    for _ in range(30):
        a = rng.standard_normal((n, n))
        a = a + a.T
        if n > 2:
            a[0, 0] = 0  # no pivot of one row here
        assert whitening.inertia(a) == (np.linalg.eigvalsh(a) > 0).sum()
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1


@pytest.mark.parametrize(
    "values",
    [[5, 4, 3, 2, 1, 0.5], [5, 5, 5, 1, 1, 1], [1, 1 - 1e-13, 1 - 2e-13, 0.3], [1e6, 1, 1e-3, 1e-6], [3, 0, 0, 0], [2.0]],
)
def test_leading_components_of_known_spectra(values):
    n = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((n, n)))
    matrix = (q * np.array(values)) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading(matrix, 8)
    np.testing.assert_allclose(found, sorted(values, reverse=True), atol=1e-12 * max(values))
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(n), atol=1e-12)
    np.testing.assert_allclose(matrix @ vectors, vectors * found, atol=1e-11 * max(values))


def _brute(rows, k):
    """(id, vector) to whitening by numpy's own eigenvectors."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    length = max(set(lengths), key=lambda x: (lengths.count(x), x))
    good = [(i, v) for i, v in good if len(v) == length]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in good], dtype=object)
    n, sums = len(good), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    c = x.astype(float) - (sums / n).astype(float)
    covariance = c.T @ c / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return [i for i, _ in good], deviation, c @ vectors / np.sqrt(values), values / np.trace(covariance)


def _check(vectors, k=8):
    rows = [(r.vec_id, r.embedding) for r in vectors.select("vec_id", "embedding").collect()]
    ids, deviation, white, explained = _brute(rows, k)
    fitted = whitening.fit(vectors, k)
    found = whitening.transform(vectors, fitted).collect()
    assert fitted.n == len(ids) and len(found) == len(ids) * k
    assert whitening.identity_error(vectors, fitted) < 1e-9
    got = {}
    for r in found:
        got.setdefault((r.component, r.vec_id), []).append(r)
    for j in range(k):
        mine = np.array([got[j + 1, i][0].whitened for i in ids])
        sign = np.sign(mine @ white[:, j])
        np.testing.assert_allclose(sign * mine, white[:, j], atol=1e-7)
        assert all(abs(got[j + 1, i][0].explained / explained[j] - 1) < 1e-9 for i in ids)
        assert [int(got[j + 1, i][0].deviation) for i in ids] == [int(d) for d in deviation]


def test_whitening_of_embeddings(spark, folder):
    _check(spark.read.parquet(f"{folder}/embeddings.parquet"))


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n long, v string, component int")


def test_rows_without_numbers_are_dropped(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(4).tolist(), 1, "x", 2) for i in range(60)]
    odd = [None, [], [1.0, None, 2.0, 3.0], [float("nan"), 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows += [(100 + i, v, 1, "x", 2) for i, v in enumerate(odd)]
    _check(_frame(spark, rows), 3)
    clean = _frame(spark, rows[:60] + [(None, [0.5, 0.5, 0.5, 0.5], 1, "x", 2)] * 2)
    found = whitening.transform(clean, whitening.fit(clean)).collect()
    assert len(found) == 62 * 4 and sum(r.vec_id is None for r in found) == 8


def test_no_spread_gives_no_components(spark):
    for rows in ([], [(1, [1.0, 2.0], 1, "x", 2)], [(i, [1.0, 2.0], 1, "x", 2) for i in range(5)]):
        vectors = _frame(spark, rows)
        fitted = whitening.fit(vectors)
        assert whitening.transform(vectors, fitted).count() == 0
        assert whitening.identity_error(vectors, fitted) == 0.0
    line = _frame(spark, [(i, [float(i), 1.0, float(-i)], 1, "x", 2) for i in range(9)])
    assert {r.component for r in whitening.transform(line, whitening.fit(line)).collect()} == {1}


def test_deviations_are_exact_beyond_longs(spark):
    rows = [(i, [float(10**k * (i % 7 - 3)) for k in (0, 3, 6)], 1, "x", 2) for i in range(50)]
    _check(_frame(spark, rows), 1)
    huge = _frame(spark, [(0, [3e38, 0.0], 1, "x", 2), (1, [-3e38, 1.0], 1, "x", 2), (2, [0.0, 2.0], 1, "x", 2)])
    assert whitening.transform(huge, whitening.fit(huge)).count() == 3
