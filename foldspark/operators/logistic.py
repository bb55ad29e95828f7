"""Logistic regression by Newton's method, for two or more classes and many row subsets at once.

Every pass reads the rows once for all fits that are still open (all folds of all
workflows): an Arrow kernel returns the log-likelihood, the gradient and the packed
upper triangle of the curvature of each fit and task. These partial sums are added
level by level (``partials``), so neither one task nor the driver meets those of all tasks. A handful of passes is enough, where gradient methods
need dozens.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from foldspark.operators.linear import independent_columns
from foldspark.operators.partials import HELD, SCHEMA, partial_rows, tasks_of, tree_sum
from foldspark.session import cached

_ITERATIONS = 40
_TOLERANCE = 1e-10
#: Most coefficients of one fit: its packed curvature is half their square.
MAX_COEFFICIENTS = 4000
#: Doubles of a slice of rows.
_SLICE = 1 << 22


class NotConverged(UserWarning):
    """A fit stopped before its steps became small, as with classes that a plane separates."""


@dataclass(frozen=True)
class ClassMember:
    """One classification over several subsets of the rows.

    ``vector`` holds ``width`` numbers a row; the design of a subset is their
    product with its table in ``maps``, or the vector itself. ``label`` is the
    0-based class, ``weights`` how often a subset holds the row.
    """

    vector: Column
    width: int
    label: Column
    classes: int
    weights: dict[str, Column]
    maps: dict[str, np.ndarray] = field(default_factory=dict)

    def terms(self, subset: str) -> int:
        return self.maps[subset].shape[1] if subset in self.maps else self.width


@dataclass(frozen=True)
class ClassFit:
    """Coefficients per class after the first, intercept first; aliased terms are zero."""

    beta: np.ndarray
    iterations: int
    converged: bool


@dataclass
class _Search:
    """Where the ascent of one fit stands."""

    member: int
    subset: int
    table: np.ndarray | None
    classes: int
    tried: np.ndarray
    beta: np.ndarray | None = None
    value: float = -np.inf
    gradient: np.ndarray | None = None
    curvature: np.ndarray | None = None
    step: np.ndarray | None = None
    factor: float = 1.0
    steps: int = 0
    done: bool = False
    converged: bool = False

    @property
    def size(self) -> int:
        """Numbers of a partial sum."""
        n = self.tried.size
        return 1 + n + n * (n + 1) // 2

    def heard(self, total: np.ndarray) -> None:
        """Take the sums at ``tried``: accept it or go back half way, then choose the next."""
        n = self.tried.size
        value = total[0]
        if self.beta is not None and value < self.value and self.factor >= 1e-4:
            self.factor *= 0.5
            self.tried = self.beta + self.factor * self.step
            return
        upper = np.triu_indices(n)
        curvature = np.zeros((n, n))
        curvature[upper] = total[1 + n :]
        curvature.T[upper] = total[1 + n :]
        self.beta, self.value, self.gradient, self.curvature = self.tried, value, total[1 : 1 + n], curvature
        kept = independent_columns(curvature)
        scale = np.sqrt(np.diag(curvature)[kept])
        step = np.zeros(n)
        inner = curvature[np.ix_(kept, kept)] / np.outer(scale, scale)
        step[kept] = np.linalg.solve(inner, self.gradient[kept] / scale) / scale
        self.steps += 1
        if float(self.gradient @ step) < _TOLERANCE * max(1.0, abs(value)):
            # separable classes end here too, but with a likelihood of one and no finite fit
            self.converged, self.done = value < -1e-6, True
        elif self.steps >= _ITERATIONS:
            self.done = True
        else:
            self.step, self.factor = step.reshape(self.beta.shape), 1.0
            self.tried = self.beta + self.step


def _add(total: np.ndarray, x: np.ndarray, label: np.ndarray, weight: np.ndarray, beta: np.ndarray) -> None:
    """Likelihood, gradient and packed curvature of some rows."""
    others, width = beta.shape
    scores = np.hstack([np.zeros((len(x), 1)), x @ beta.T])
    top = scores.max(axis=1, keepdims=True)
    weights = np.exp(scores - top)
    mass = weights.sum(axis=1)
    share = weights[:, 1:] / mass[:, None]
    chosen = np.take_along_axis(scores, label[:, None], axis=1)[:, 0]
    size = beta.size
    total[0] += (weight * (chosen - top[:, 0] - np.log(mass))).sum()
    hit = label[:, None] == np.arange(1, others + 1)[None, :]
    total[1 : 1 + size] += (((hit - share) * weight[:, None]).T @ x).ravel()
    at = 1 + size
    rows, columns = np.triu_indices(width)
    pieces: dict[tuple[int, int], np.ndarray] = {}
    for a in range(others):
        for b in range(a, others):
            w = weight * share[:, a] * ((a == b) - share[:, b])
            pieces[a, b] = (x * w[:, None]).T @ x
    if others == 1:
        total[at:] += pieces[0, 0][rows, columns]
        return
    for a in range(others):
        for i in range(width):
            # row (a, i) of the triangle: the rest of its own block, then whole rows of later blocks
            line = np.concatenate([pieces[a, a][i, i:], *[pieces[a, b][i] for b in range(a + 1, others)]])
            total[at : at + len(line)] += line
            at += len(line)


def _kernel(fits: list[tuple[int, _Search]], widths: list[int]):
    used = sorted({s.member for _, s in fits})

    def run(batches):
        totals = {k: np.zeros(s.size) for k, s in fits}
        for batch in batches:
            for m in used:
                own = [(k, s) for k, s in fits if s.member == m]
                width = widths[m]
                step = max(1, _SLICE // (width + 1))
                for begin in range(0, batch.num_rows, step):
                    rows = batch.slice(begin, step)
                    n = rows.num_rows
                    block = rows.column(f"d{m}").flatten().to_numpy(zero_copy_only=False).reshape(n, width)
                    label = rows.column(f"y{m}").to_numpy(zero_copy_only=False).astype(float)
                    weight = rows.column(f"w{m}").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                    known = np.isfinite(label) & np.isfinite(block).all(axis=1)
                    block, label, weight = block[known], label[known].astype(int), weight[known]
                    for k, s in own:
                        times = weight[:, s.subset]
                        some = times > 0
                        x = block[some] if s.table is None else block[some] @ s.table
                        x = np.hstack([np.ones((len(x), 1)), x])
                        _add(totals[k], x, label[some], times[some].astype(float), s.tried)
        yield from partial_rows(totals)

    return run


def _waves(fits: list[tuple[int, _Search]]):
    """Fits in runs whose partial sums a task can hold together."""
    wave, held = [], 0
    for k, s in fits:
        if wave and held + s.size > HELD:
            yield wave
            wave, held = [], 0
        wave.append((k, s))
        held += s.size
    if wave:
        yield wave


def fit_logistic_set(rows: DataFrame, members: dict[str, ClassMember]) -> dict[tuple[str, str], ClassFit]:
    """Every member over every one of its subsets; ``NotConverged`` is warned of where a fit has no finite end."""
    names = list(members)
    columns, keys, searches = [], [], []
    for m, name in enumerate(names):
        one = members[name]
        columns += [
            one.vector.alias(f"d{m}"),
            one.label.cast("int").alias(f"y{m}"),
            F.array(*[w.cast("int") for w in one.weights.values()]).alias(f"w{m}"),
        ]
        for k, subset in enumerate(one.weights):
            shape = (one.classes - 1, one.terms(subset) + 1)
            if shape[0] * shape[1] > MAX_COEFFICIENTS:
                raise ValueError(f"{shape[0] * shape[1]} coefficients; at most {MAX_COEFFICIENTS} are fitted")
            keys.append((name, subset))
            searches.append(_Search(m, k, one.maps.get(subset), one.classes, np.zeros(shape)))
    widths = [members[n].width for n in names]
    with cached(rows.select(*columns)) as known:
        tasks = tasks_of(known)
        while open_ := [(k, s) for k, s in enumerate(searches) if not s.done]:
            for wave in _waves(open_):
                parts = known.mapInArrow(_kernel(wave, widths), SCHEMA)
                found = tree_sum(parts, max(s.size for _, s in wave), tasks)
                for k, search in wave:
                    # a table without a row or a task has no sums
                    search.heard(found.get(k, np.zeros(search.size)))
    out = {}
    for key, s in zip(keys, searches):
        out[key] = ClassFit(s.beta, s.steps, s.converged)
        if not s.converged:
            warnings.warn(f"no finite fit found in {s.steps} steps ({'/'.join(key)})", NotConverged, stacklevel=2)
    return out


def fit_logistic(rows: DataFrame, width: int, classes: int) -> tuple[np.ndarray, int, bool]:
    """One fit over all rows, which hold ``d`` (the design as an array) and ``label`` (0-based class).

    Coefficients per class after the first, the number of steps, and whether they converged.
    """
    member = ClassMember(F.col("d"), width, F.col("label"), classes, {"all": F.lit(1)})
    fit = fit_logistic_set(rows, {"model": member})["model", "all"]
    return fit.beta, fit.iterations, fit.converged
