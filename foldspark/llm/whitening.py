"""Whitening of embeddings; the leading components by slicing the spectrum.

An entry c becomes the whole number floor(1024 c) + 100000, so counts, sums and
deviations are exact. Workers sum the entries, then the products of the centred
vectors; the driver sees one covariance matrix, whose size is that of a vector
squared, never rows.

The leading eigenvalues of the covariance are found by counting. A symmetric
factorisation L D Lᵀ of the matrix less a shift (with pivots of one or two rows) has
as many positive entries in D as there are eigenvalues above the shift (Sylvester's
law of inertia). Halving intervals by such counts isolates each leading eigenvalue;
Rayleigh quotient iteration, begun in its interval, then converges to the eigenvector
cubically; and counts on both sides of the quotient certify that it is the eigenvalue
of that number. Eigenvalues that agree to rounding share an interval and get
orthogonal vectors of their common space.

Defined cases: rows whose vector is null or holds null or non-finite entries are
dropped; the dimension is the length that most of the other vectors have (the longer
of two as frequent), and vectors of other lengths, empty ones too, are dropped; components without spread
(an eigenvalue below 10^-12 of the trace) are not returned, so a table of equal
vectors, or of one, gives no rows, like an empty one; a null or repeated vec_id is kept as it is; an entry
too large for a long is taken at the long's limit; a deviation of more than 38 digits is null; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
#: Eigenvalues below this share of the trace have no spread to whiten.
FLAT = 1e-12
_LIMIT = float(2**63 - 1024)


def inertia(matrix: np.ndarray) -> int:
    """Number of positive eigenvalues of a symmetric matrix, from its factorisation with pivots of one or two rows."""
    a = np.array(matrix, dtype=float)
    n, k, positive = len(a), 0, 0
    ratio = (1 + 17**0.5) / 8
    while k < n:
        size = 1
        if k + 1 < n:
            below = np.abs(a[k + 1 :, k])
            r = k + 1 + int(below.argmax())
            largest = below[r - k - 1]
            pivot = k
            if abs(a[k, k]) < ratio * largest:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                others = row.max()
                if abs(a[k, k]) * others >= ratio * largest**2:
                    pass
                elif abs(a[r, r]) >= ratio * others:
                    pivot = r
                else:
                    pivot, size = r, 2
            to = k + size - 1
            if pivot != to:
                a[[to, pivot]] = a[[pivot, to]]
                a[:, [to, pivot]] = a[:, [pivot, to]]
        end = k + size
        if size == 1:
            d = a[k, k]
            positive += d > 0
            if d != 0:
                column = a[end:, k]
                a[end:, end:] -= np.outer(column / d, column)
        else:
            # the pivots are chosen so that such a block has one eigenvalue of either sign
            positive += int((np.linalg.eigvalsh(a[k:end, k:end]) > 0).sum())
            columns = a[end:, k:end]
            a[end:, end:] -= columns @ np.linalg.solve(a[k:end, k:end], columns.T)
        k = end
    return int(positive)


class Slices:
    """Counts of the eigenvalues above shifts, each made once."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
        n = len(matrix)
        # all eigenvalues lie between the row sums' bounds
        edge = self.scale * (1 + 1e-9) + 1e-300
        self.known = {-edge: n, edge: 0}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = inertia(self.matrix - shift * np.eye(len(self.matrix)))
        return self.known[shift]

    def bracket(self, k: int) -> tuple[float, float]:
        """The closest known shifts around eigenvalue ``k`` (from 1, falling)."""
        low = max(s for s, c in self.known.items() if c >= k)
        return low, min(s for s, c in self.known.items() if c < k and s > low)

    def isolate(self, k: int) -> tuple[float, float, bool]:
        """Shifts that hold eigenvalue ``k`` alone, or, told by False, several that agree to rounding."""
        while True:
            low, high = self.bracket(k)
            alone = self.above(low) == k and self.above(high) == k - 1
            if alone or high - low <= 4e-15 * self.scale:
                return low, high, alone
            middle = (low + high) / 2
            if not low < middle < high:
                return low, high, False
            self.above(middle)


def _solve(matrix: np.ndarray, shift: float, vector: np.ndarray, scale: float) -> np.ndarray:
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        return np.linalg.solve(shifted, vector)
    except np.linalg.LinAlgError:
        return np.linalg.solve(shifted + 1e-16 * scale * np.eye(len(matrix)), vector)


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) and their unit eigenvectors, as columns."""
    slices, n = Slices(matrix), len(matrix)
    scale = slices.scale
    values, vectors = [], np.zeros((n, 0))
    start = np.random.default_rng(0)

    def clear(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - vectors @ (vectors.T @ v)
        return v / np.linalg.norm(v)

    for k in range(1, min(wanted, n) + 1):
        if scale == 0:
            break
        tries = 0
        while True:
            low, high, alone = slices.isolate(k)
            shift = (low + high) / 2
            v = clear(start.standard_normal(n))
            for _ in range(2):
                v = clear(_solve(matrix, shift, v, scale))
            for _ in range(12):
                value = float(v @ matrix @ v)
                residual = float(np.linalg.norm(matrix @ v - value * v))
                if not low <= value <= high or residual <= 1e-15 * scale:
                    break
                after = clear(_solve(matrix, value, v, scale))
                gained = float(np.linalg.norm(matrix @ after - float(after @ matrix @ after) * after))
                if gained >= residual:  # rounding is reached
                    break
                v = after
            value = float(v @ matrix @ v)
            residual = float(np.linalg.norm(matrix @ v - value * v))
            near = max(2 * residual, 4e-14 * scale)
            certain = residual <= 1e-10 * scale and slices.above(value + near) < k <= slices.above(value - near)
            if certain:
                break
            tries += 1
            if tries > 60:
                raise ArithmeticError(f"eigenvalue {k} could not be certified")
            slices.above((low + high) / 2)  # a narrower interval, another start
        values.append(value)
        vectors = np.column_stack([vectors, v])
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], vectors[:, order]


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    entry_is_number = F.forall(
        "v", lambda c: F.coalesce((F.abs(c.cast("double")) < F.lit(float("inf"))) & ~F.isnan(c.cast("double")), F.lit(False))
    )
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & entry_is_number)


def _whole_numbers(column: pa.ListArray, length: int) -> np.ndarray:
    """The vectors of a batch, one a row, as whole numbers."""
    c = pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(-1, length)
    x = np.floor(SCALE * c) + SHIFT
    return np.clip(x, -_LIMIT, _LIMIT).astype(np.int64)


def _sums(rows: DataFrame) -> tuple[int, int, list[int]]:
    """Length of the vectors, their number and the exact sum of each entry."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            column = batch.column("v")
            lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths).tolist():
                x = _whole_numbers(column.filter(pa.array(lengths == length)), length)
                # in two halves, so that no sum leaves a long
                state = found.setdefault(length, [0, np.zeros(length, np.int64), np.zeros(length, np.int64)])
                state[0] += len(x)
                state[1] += (x >> 32).sum(axis=0)
                state[2] += (x & 0xFFFFFFFF).sum(axis=0)
        for length, (n, high, low) in found.items():
            yield pa.RecordBatch.from_pydict(
                {"length": pa.array([length], pa.int32()), "n": pa.array([n], pa.int64()), "high": [high.tolist()], "low": [low.tolist()]}
            )

    parts = rows.select("v").mapInArrow(partial, "length int, n long, high array<long>, low array<long>").persist()
    try:
        best = parts.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
        if not best:
            return 0, 0, []
        length, n = best[0]["length"], best[0]["n"]
        halves = (
            parts.filter(F.col("length") == length)
            .select(F.posexplode(F.arrays_zip("high", "low")).alias("at", "half"))
            .groupBy("at")
            .agg(*[F.sum(F.col(f"half.{h}").cast("decimal(38,0)")).alias(h) for h in ("high", "low")])
        )
        sums = {r["at"]: (int(r["high"]) << 32) + int(r["low"]) for r in halves.collect()}
    finally:
        parts.unpersist()
    return length, n, [sums[i] for i in range(length)]


def _products(rows: DataFrame, length: int, width: int, of) -> np.ndarray:
    """Sum over all rows of the outer products of ``of(x)``, whose width is ``width``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        some = False
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                c = of(_whole_numbers(batch.column("v").slice(begin, 4096), length))
                total += c.T @ c
                some = True
        if some:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(width), pa.int32()), "row": list(total)})

    def added(table: pa.Table) -> pa.Table:
        rows = np.stack([np.asarray(r) for r in table.column("row").to_pylist()])
        return pa.table({"i": table.column("i").slice(0, 1), "row": [rows.sum(axis=0)]})

    schema = "i int, row array<double>"
    parts = rows.select("v").mapInArrow(partial, schema).groupBy("i").applyInArrow(added, schema)
    out = np.zeros((width, width))
    for r in parts.collect():
        out[r["i"]] = r["row"]
    return (out + out.T) / 2


@dataclass
class Whitening:
    """What was fitted: everything but the rows."""

    n: int
    sums: list[int]
    #: trace of the covariance, leading eigenvalues, eigenvectors as columns
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def length(self) -> int:
        return len(self.sums)

    def centred(self):
        mean = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return lambda x: (x - mean).astype(float) - rest

    def whitened(self):
        centre, to = self.centred(), self.vectors / np.sqrt(self.values)
        return lambda x: centre(x) @ to


def fit(vectors: DataFrame, components: int = 8, vector_col: str = "embedding") -> Whitening:
    """Exact sums, covariance and leading components of all usable vectors."""
    rows = _usable(vectors, vector_col, vector_col)
    length, n, sums = _sums(rows)
    found = Whitening(n, sums, 0.0, np.zeros(0), np.zeros((length, 0)))
    if n == 0:
        return found
    covariance = _products(rows.filter(F.size("v") == length), length, length, found.centred()) / n
    found.trace = float(np.trace(covariance))
    values, columns = leading(covariance, components)
    steep = values > FLAT * found.trace
    found.values, found.vectors = values[steep], columns[:, steep]
    return found


def identity_error(vectors: DataFrame, fitted: Whitening, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k = len(fitted.values)
    if k == 0:
        return 0.0
    rows = _usable(vectors, vector_col, vector_col).filter(F.size("v") == fitted.length)
    project = fitted.whitened()
    products = _products(rows, fitted.length, k + 1, lambda x: np.column_stack([project(x), np.ones(len(x))])) / fitted.n
    means = products[:k, k]
    return float(np.abs(products[:k, :k] - np.outer(means, means) - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum of (n x - S)^2 per row, exactly."""
    furthest = max((max(abs(n * int(a) - s), abs(n * int(b) - s)) for a, b, s in zip(x.min(axis=0), x.max(axis=0), sums)), default=0)
    largest = max(abs(int(x.min())), abs(int(x.max())), *map(abs, sums))
    kind = pa.decimal128(38, 0)
    if n * largest < 2**63 and furthest**2 * len(sums) < 2**63:
        y = x * np.int64(n) - np.array(sums, dtype=np.int64)
        return pa.array((y * y).sum(axis=1)).cast(kind)
    y = x.astype(object) * n - np.array(sums, dtype=object)
    return pa.array([Decimal(d) if d < 10**38 else None for d in (y * y).sum(axis=1)], kind)


def transform(vectors: DataFrame, fitted: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per usable vector and component: vec_id, component, deviation (decimal), whitened, explained."""
    k = len(fitted.values)
    rows = _usable(vectors, id_col, vector_col).filter(F.size("v") == max(fitted.length, 1))
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, deviation decimal(38,0), whitened double, explained double"
    explained = fitted.values / fitted.trace if k else np.zeros(0)
    project = fitted.whitened() if k else None

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if k == 0 or batch.num_rows == 0:
                continue
            x = _whole_numbers(batch.column("v"), fitted.length)
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    _deviations(x, fitted.n, fitted.sums).take(pa.array(each)),
                    pa.array(project(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                ],
                names=["vec_id", "component", "deviation", "whitened", "explained"],
            )

    return rows.mapInArrow(rotate, schema)
