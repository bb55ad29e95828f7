"""Natural cubic spline bases evaluated inside the JVM.

The driver turns the knots into one cubic polynomial per basis function and knot
interval. Rows then look up their interval and evaluate the polynomials with
array functions, so no Python worker is involved.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

from foldspark.functions.constants import array_constant

_ORDER = 4  # cubic
_NODES = np.array([0.0, 1.0 / 3.0, 2.0 / 3.0, 1.0])


def knot_probabilities(deg_free: int) -> list[float]:
    """Quantile levels: both ends, and deg_free - 1 evenly spaced inside."""
    return [0.0, *[i / deg_free for i in range(1, deg_free)], 1.0]


def _b_splines(x: np.ndarray, knots: np.ndarray, left: int) -> np.ndarray:
    """All cubic B-splines at points of the knot interval that starts at ``left``."""
    n_zero = len(knots) - 1
    basis = np.zeros((len(x), n_zero))
    basis[:, left] = 1.0
    for degree in range(1, _ORDER):
        raised = np.zeros_like(basis)
        for i in range(n_zero - degree):
            span = knots[i + degree] - knots[i]
            if span > 0:
                raised[:, i] += (x - knots[i]) / span * basis[:, i]
            span = knots[i + degree + 1] - knots[i + 1]
            if span > 0:
                raised[:, i] += (knots[i + degree + 1] - x) / span * basis[:, i + 1]
        basis = raised
    return basis[:, : n_zero - degree]


class NaturalSpline:
    """A basis that is cubic between knots and linear beyond the boundary knots."""

    def __init__(self, quantiles: list[float]):
        low, high = quantiles[0], quantiles[-1]
        if low is None or not low < high:
            raise ValueError("a spline needs a column with at least two distinct values")
        interior = [q for q in quantiles[1:-1] if low < q < high]
        knots = np.array([low] * _ORDER + interior + [high] * _ORDER)
        self.breaks = np.unique(knots)
        pieces = []
        for start, stop in zip(self.breaks[:-1], self.breaks[1:]):
            left = int(np.searchsorted(knots, start, side="right")) - 1
            values = _b_splines(start + (stop - start) * _NODES, knots, left)
            # coefficients in the interval's own unit coordinate
            pieces.append(np.linalg.solve(np.vander(_NODES, 4, increasing=True), values))
        pieces = np.array(pieces)[:, :, 1:]  # the first function is the intercept's
        widths = np.diff(self.breaks)
        bends = np.array(
            [
                2.0 * pieces[0, 2] / widths[0] ** 2,
                (2.0 * pieces[-1, 2] + 6.0 * pieces[-1, 3]) / widths[-1] ** 2,
            ]
        )
        free = np.linalg.qr((bends / np.abs(bends).max(axis=1, keepdims=True)).T, mode="complete")
        pieces = pieces @ free[0][:, 2:]
        before = np.zeros_like(pieces[0])
        before[:2] = pieces[0][:2]
        after = np.zeros_like(pieces[0])
        after[0] = pieces[-1].sum(axis=0)
        after[1] = pieces[-1][1] + 2.0 * pieces[-1][2] + 3.0 * pieces[-1][3]
        # one piece per interval, plus a linear piece on each side
        self.pieces = np.concatenate([[before], pieces, [after]])
        self.origins = np.concatenate([[self.breaks[0]], self.breaks])
        self.widths = np.concatenate([[widths[0]], widths, [widths[-1]]])

    @property
    def size(self) -> int:
        return self.pieces.shape[2]

    def values(self, x: np.ndarray) -> np.ndarray:
        """The basis at a vector of points, on the driver (plot grids, tests)."""
        j = np.searchsorted(self.breaks, x, side="right")
        s = ((np.asarray(x, dtype=float) - self.origins[j]) / self.widths[j])[:, None]
        c = self.pieces[j]
        return ((c[:, 3] * s + c[:, 2]) * s + c[:, 1]) * s + c[:, 0]

    def local(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Breaks, origins, widths, and the basis over the four Bernstein cubics of every interval.

        The linear pieces at the ends are over 1 - s and s instead, with two unused rows.
        """
        c = self.pieces
        table = np.stack(
            [c[:, 0], c[:, 0] + c[:, 1] / 3, c[:, 0] + (2 * c[:, 1] + c[:, 2]) / 3, c.sum(axis=1)], axis=1
        )
        for end in (0, -1):
            table[end] = np.stack([c[end, 0], c[end, 0] + c[end, 1], 0 * c[end, 0], 0 * c[end, 0]])
        return self.breaks, self.origins, self.widths, table.reshape(-1, self.size)

    def column(self, x: Column) -> Column:
        """The basis of a column as ``array<double>``; NULL gives NULL elements."""
        pieces = array_constant(
            np.transpose(self.pieces, (0, 2, 1)).tolist(), "array<array<array<double>>>"
        )
        return self._at(
            x,
            lambda j, s: F.transform(
                F.get(pieces, j),
                lambda c: ((F.get(c, F.lit(3)) * s + F.get(c, F.lit(2))) * s + F.get(c, F.lit(1))) * s
                + F.get(c, F.lit(0)),
            ),
        )

    def score(self, x: Column, weights: np.ndarray) -> Column:
        """The weighted sum of the basis at a column: one cubic per interval; NULL gives NULL."""
        cubics = (self.pieces @ weights).T
        terms = [array_constant(c.tolist()) for c in cubics]

        def cubic(j: Column, s: Column) -> Column:
            c = [F.get(t, j) for t in terms]
            return ((c[3] * s + c[2]) * s + c[1]) * s + c[0]

        return self._at(x, cubic)

    def _at(self, x: Column, body) -> Column:
        """``body`` of the number of the interval and the place in it."""
        breaks = array_constant(self.breaks.tolist())
        origins = array_constant(self.origins.tolist())
        widths = array_constant(self.widths.tolist())
        x = x.cast("double")
        # the breaks up to x, counted by halving: a break past the last is missing and not passed
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(self.breaks).bit_length()))])
        interval = F.aggregate(
            steps, F.lit(0), lambda j, step: j + F.when(F.get(breaks, j + step - 1) <= x, step).otherwise(0)
        )

        def at_interval(j: Column) -> Column:
            unit = (x - F.get(origins, j)) / F.get(widths, j)
            # single-element arrays keep interval and point from being recomputed
            return F.get(F.transform(F.array(unit), lambda s: body(j, s)), F.lit(0))

        return F.get(F.transform(F.array(interval), at_interval), F.lit(0))
