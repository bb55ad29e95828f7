"""Linear mixed models with a random intercept, and optionally a random slope, per group.

The rows are reduced once to cross-products per group, of columns centred at their
means, so that a large offset costs no digits. The restricted likelihood of any
variance parameters is then a sum over groups, and so are its derivatives: each
round of Newton's method is one aggregation over the group table, which scores the
parameters and the points around them for every resample that is still open, at
several lengths of the step at once. The
number of rows no longer matters, and a handful of rounds is enough.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldspark.operators.linear import INTERCEPT
from foldspark.operators.partials import SCHEMA, partial_rows, tasks_of, tree_sum
from foldspark.operators.recipe import PreparedRecipe
from foldspark.session import cut_lineage

_ROUNDS = 60
_TOLERANCE = 1e-9
#: Distance of the points whose gradients give the curvature.
_NEARBY = 1e-4
#: Lengths of a step that are tried in one round.
_FACTORS = (1.0, 0.5, 0.2, 0.05)
#: Standard deviations of the random effects, relative to the residual one, where the search looks first.
_STARTS = (0.05, 0.3, 1.0, 3.0)


@dataclass(frozen=True)
class MixedFit:
    """Fixed effects, covariance of the random effects and residual variance."""

    terms: tuple[str, ...]
    fixed: np.ndarray
    fixed_cov: np.ndarray
    random_cov: np.ndarray  # intercept, and slope if there is one
    sigma2: float
    criterion: float  # restricted deviance
    n: float
    groups: int
    iterations: int = 0
    converged: bool = True

    def tidy_rows(self) -> list[tuple]:
        rows = [
            ("fixed", term, float(b), float(np.sqrt(v)))
            for term, b, v in zip(self.terms, self.fixed, np.diag(self.fixed_cov))
        ]
        sd = np.sqrt(np.maximum(np.diag(self.random_cov), 0.0))
        rows.append(("random", "sd_intercept", float(sd[0]), None))
        if len(sd) > 1:
            both = sd[0] * sd[1]
            correlation = float(self.random_cov[0, 1] / both) if both > 0 else None
            rows += [("random", "sd_slope", float(sd[1]), None), ("random", "correlation", correlation, None)]
        return [*rows, ("random", "sd_residual", float(np.sqrt(self.sigma2)), None)]

    def tidy(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.tidy_rows(), "effect string, term string, estimate double, std_error double"
        )


@dataclass(frozen=True)
class _Design:
    """Columns of the cross-products: the intercept, fixed terms, the slope if any, the outcome."""

    terms: tuple[str, ...]
    random: int
    centre: np.ndarray  # of the columns after the intercept
    spread: np.ndarray

    @property
    def fixed(self) -> int:
        return 1 + len(self.terms)

    @property
    def size(self) -> int:
        return self.fixed + self.random

    @property
    def random_at(self) -> list[int]:
        return [0, self.fixed][: self.random]


def _columns(prepared: PreparedRecipe, group: str, slope: str | None) -> Column:
    outcome = F.col(prepared.recipe.outcome).cast("double")
    own = [] if slope is None else [F.col(slope).cast("double")]
    return F.concat(prepared.design(), F.array(*own, outcome))


def _group_table(
    prepared: PreparedRecipe, df: DataFrame, group: str, slope: str | None, weights: dict[str, Column]
) -> tuple[DataFrame, _Design]:
    """Cross-products of the columns per resample and group: k (its number), g, cells."""
    terms = tuple(prepared.terms)
    width = len(terms) + (slope is not None) + 1
    times = F.array(*[w.cast("double") for w in weights.values()])
    rows = df.select(F.col(group).alias("g"), _columns(prepared, group, slope).alias("z"), times.alias("w"))
    rows = rows.where(F.col("g").isNotNull() & F.forall("z", lambda v: v.isNotNull() & ~F.isnan(v)))
    # scalar columns keep the sums inside generated code
    rows = rows.select("g", "w", *[F.get("z", F.lit(i)).alias(f"z{i}") for i in range(width)])
    moments = rows.agg(
        *[F.avg(f"z{i}").alias(f"m{i}") for i in range(width)], *[F.stddev_pop(f"z{i}").alias(f"s{i}") for i in range(width)]
    ).first()
    centre = np.array([moments[f"m{i}"] or 0.0 for i in range(width)])
    spread = np.array([moments[f"s{i}"] or 1.0 for i in range(width)])
    unit = [F.lit(1.0), *[(F.col(f"z{i}") - float(centre[i])) / float(spread[i]) for i in range(width)]]
    rows = rows.select("g", "w", *[c.alias(f"u{i}") for i, c in enumerate(unit)])
    pairs = [(i, j) for i in range(width + 1) for j in range(i, width + 1)]
    each = rows.select("g", F.posexplode("w").alias("k", "t"), *[f"u{i}" for i in range(width + 1)]).where("t > 0")
    cells = F.array(*[F.sum(F.col("t") * F.col(f"u{i}") * F.col(f"u{j}")) for i, j in pairs])
    table = each.groupBy("k", "g").agg(cells.alias("cells"))
    return table, _Design(terms, 1 if slope is None else 2, centre, spread)


def _unpack(cells: np.ndarray, size: int) -> np.ndarray:
    full = np.zeros((len(cells), size, size))
    a, b = np.triu_indices(size)
    full[:, a, b] = cells
    full[:, b, a] = cells
    return full


def _factor(theta: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lower triangle of the random effects' relative covariance, and its derivatives."""
    q = 1 if len(theta) == 1 else 2
    places = [(0, 0)] if q == 1 else [(0, 0), (1, 0), (1, 1)]
    lam, units = np.zeros((q, q)), []
    for (i, j), t in zip(places, theta):
        lam[i, j] = t
        unit = np.zeros((q, q))
        unit[i, j] = 1.0
        units.append(unit)
    return lam, units


def _score_kernel(points: dict[int, np.ndarray], design: _Design):
    """Per batch of groups: the additive parts of the likelihood and its gradient at every point of a resample."""
    p, q = design.fixed, design.random
    z_at, w_at = design.random_at, [*range(p), design.size - 1]
    n_theta = q * (q + 1) // 2
    block = (p + 1) ** 2
    width = 1 + n_theta + block * (1 + n_theta)

    def parts(full: np.ndarray, theta: np.ndarray) -> np.ndarray:
        lam, units = _factor(theta)
        zz, zw = full[:, z_at][:, :, z_at], full[:, z_at][:, :, w_at]
        ww = full[:, w_at][:, :, w_at]
        inner = np.linalg.inv(lam.T @ zz @ lam + np.eye(q))
        spread = lam @ inner  # of the derivatives' outer factors
        side = np.swapaxes(zw, 1, 2)
        out = np.empty(width)
        out[0] = -np.linalg.slogdet(inner)[1].sum()
        out[1 + n_theta : 1 + n_theta + block] = (ww - side @ (spread @ lam.T) @ zw).sum(axis=0).ravel()
        for i, unit in enumerate(units):
            change = unit.T @ zz @ lam
            change = change + np.swapaxes(change, 1, 2)
            out[1 + i] = np.einsum("gij,gji->", inner, change)
            moved = unit @ inner @ lam.T
            moved = moved + np.swapaxes(moved, 1, 2) - spread @ change @ np.swapaxes(spread, 1, 2)
            at = 1 + n_theta + block * (1 + i)
            out[at : at + block] = -(side @ moved @ zw).sum(axis=0).ravel()
        return out

    def kernel(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            full = _unpack(batch.column("cells").flatten().to_numpy().reshape(batch.num_rows, -1), design.size)
            ks = batch.column("k").to_numpy()
            for k in np.unique(ks).tolist():
                if k in points:
                    own = full[ks == k]
                    found = np.concatenate([parts(own, theta) for theta in points[k]])
                    total[k] = total[k] + found if k in total else found
        yield from partial_rows(total)

    return kernel, width


def _scored(table: DataFrame, points: dict[int, np.ndarray], design: _Design, tasks: int) -> dict[int, np.ndarray]:
    """Per resample the parts of every point, one a row, summed over the groups."""
    kernel, width = _score_kernel(points, design)
    summed = tree_sum(table.mapInArrow(kernel, SCHEMA), max(len(p) for p in points.values()) * width, tasks)
    return {k: total.reshape(-1, width) for k, total in summed.items()}


@dataclass
class _Search:
    """Newton's method on the restricted deviance of one resample.

    The deviance does not change with the sign of a column of the factor, so no
    bound is needed: a variance of zero is an ordinary minimum.
    """

    n: float
    groups: int
    design: _Design
    #: places to look at in the next round, one a row
    tried: np.ndarray
    accepted: np.ndarray | None = None
    deviance: float = np.inf
    step: np.ndarray | None = None
    solved: tuple = ()
    rounds: int = 0
    done: bool = False
    converged: bool = False
    shrunk: float = 1.0

    def points(self) -> np.ndarray:
        """Every place with its neighbours in all directions."""
        n = self.tried.shape[1]
        around = np.vstack([np.zeros(n), _NEARBY * np.eye(n), -_NEARBY * np.eye(n)])
        return (self.tried[:, None, :] + around).reshape(-1, n)

    def _deviance(self, parts: np.ndarray) -> tuple[float, np.ndarray, tuple]:
        p, n_theta = self.design.fixed, self.tried.shape[1]
        block = (p + 1) ** 2
        at = 1 + n_theta
        joint = parts[at : at + block].reshape(p + 1, p + 1)
        xx, xy, yy = joint[:p, :p], joint[:p, p], joint[p, p]
        # aliased fixed terms have no share in either
        values, vectors = np.linalg.eigh(xx)
        kept = values > 1e-10 * max(values.max(), 1e-300)
        inverse = (vectors[:, kept] / values[kept]) @ vectors[:, kept].T
        beta = inverse @ xy
        rss = max(yy - xy @ beta, 1e-300)
        free = self.n - p
        u = np.append(-beta, 1.0)
        gradient = np.empty(n_theta)
        for i in range(n_theta):
            moved = parts[at + block * (1 + i) : at + block * (2 + i)].reshape(p + 1, p + 1)
            gradient[i] = parts[1 + i] + (inverse * moved[:p, :p]).sum() + free * (u @ moved @ u) / rss
        deviance = parts[0] + np.log(values[kept]).sum() + free * (1.0 + np.log(2 * np.pi * rss / free))
        return float(deviance), gradient, (beta, inverse, rss / free)

    def heard(self, parts: np.ndarray) -> None:
        """Take the sums at all points, one a row: go on from the lowest place, or look nearer by."""
        self.rounds += 1
        n = self.tried.shape[1]
        own = 1 + 2 * n
        places = [self._deviance(parts[i]) for i in range(0, len(parts), own)]
        best = int(np.argmin([p[0] for p in places]))
        deviance, gradient, solved = places[best]
        if deviance > self.deviance + 1e-9 and self.shrunk > 1e-6:
            self.shrunk *= min(_FACTORS) / 2
            self._look(self.step * self.shrunk)
            return
        near = [self._deviance(p)[1] for p in parts[best * own + 1 : (best + 1) * own]]
        curvature = np.array([(near[i] - near[n + i]) / (2 * _NEARBY) for i in range(n)])
        curvature = (curvature + curvature.T) / 2
        values, vectors = np.linalg.eigh(curvature)
        along = vectors.T @ gradient
        # downhill in every direction, also where the deviance is not yet bowl-shaped
        floor = max(np.abs(values).max() * 1e-8, 1e-10)
        step = -vectors @ (along / np.maximum(np.abs(values), floor))
        step = step / max(np.abs(step).max(), 1.0)
        self.accepted, self.deviance, self.solved = self.tried[best], deviance, solved
        if abs(gradient @ step) < _TOLERANCE * max(1.0, abs(deviance)):
            self.done = self.converged = True
            return
        self.step, self.shrunk = step, 1.0
        self._look(step)

    def _look(self, step: np.ndarray) -> None:
        self.tried = self.accepted + np.array(_FACTORS)[:, None] * step
        self.done = self.rounds >= _ROUNDS

    def fit(self) -> MixedFit:
        """In the units of the raw columns."""
        d = self.design
        beta, inverse, sigma2 = self.solved
        p, y_spread = d.fixed, d.spread[-1]
        # raw coefficients: y = centre + spread (b0 + sum b (x - centre) / spread)
        back = np.eye(p)
        back[0, 1:] = -d.centre[: p - 1] / d.spread[: p - 1]
        back[range(1, p), range(1, p)] = 1.0 / d.spread[: p - 1]
        fixed = y_spread * (back @ beta)
        fixed[0] += d.centre[-1]
        lam, _ = _factor(self.accepted)
        turn = np.eye(d.random)
        if d.random == 2:
            turn[0, 1] = -d.centre[p - 1] / d.spread[p - 1]
            turn[1, 1] = 1.0 / d.spread[p - 1]
        scale = y_spread**2 * sigma2
        return MixedFit(
            (INTERCEPT, *d.terms),
            fixed,
            scale * back @ inverse @ back.T,
            scale * turn @ lam @ lam.T @ turn.T,
            float(scale),
            float(self.deviance + 2 * (self.n - p) * np.log(y_spread) + 2 * np.log(d.spread[: p - 1]).sum()),
            self.n,
            self.groups,
            self.rounds,
            self.converged,
        )


def _search(table: DataFrame, design: _Design) -> dict[int, _Search]:
    """One search per resample, all in common rounds."""
    totals = table.groupBy("k").agg(F.sum(F.get("cells", F.lit(0))).alias("n"), F.count("*").alias("groups")).collect()
    if design.random == 1:
        start = np.array([[a] for a in _STARTS])
    else:
        # correlated both ways, and not at all
        start = np.array([[a, c, b] for a in _STARTS for c in (-0.5, 0.0, 0.5) for b in _STARTS[:2]])
    tasks = tasks_of(table)
    searches = {r["k"]: _Search(r["n"], r["groups"], design, start) for r in totals}
    while open_ := {k: s for k, s in searches.items() if not s.done}:
        found = _scored(table, {k: s.points() for k, s in open_.items()}, design, tasks)
        for k, s in open_.items():
            s.heard(found[k])
    return searches


def _effects_kernel(fits: dict[int, tuple[np.ndarray, np.ndarray]], design: _Design):
    """Per group the expected random effects, in raw units; ``fits`` holds factor and fixed effects."""
    p, q = design.fixed, design.random
    z_at, x_at, y_at = design.random_at, list(range(p)), design.size - 1
    y_spread = design.spread[-1]
    turn = np.eye(q)
    if q == 2:
        turn[0, 1] = -design.centre[p - 1] / design.spread[p - 1]
        turn[1, 1] = 1.0 / design.spread[p - 1]

    def kernel(batches):
        for batch in batches:
            cells = batch.column("cells")
            full = _unpack(cells.flatten().to_numpy().reshape(batch.num_rows, -1), design.size)
            ks = batch.column("k").to_numpy()
            effects = np.zeros((batch.num_rows, q))
            for k in np.unique(ks):
                lam, beta = fits[int(k)]
                own = full[ks == k]
                zz = own[:, z_at][:, :, z_at]
                rest = own[:, z_at][:, :, y_at] - own[:, z_at][:, :, x_at] @ beta
                inner = lam.T @ zz @ lam + np.eye(q)
                effects[ks == k] = np.linalg.solve(inner, (rest @ lam)[:, :, None])[:, :, 0] @ lam.T
            effects = y_spread * effects @ turn.T
            slope = effects[:, 1] if q == 2 else np.zeros(len(effects))
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("g"), pa.array(effects[:, 0].copy()), pa.array(slope.copy())],
                names=["k", "g", "intercept", "slope"],
            )

    return kernel


def fit_mixed_set(
    prepared: PreparedRecipe, df: DataFrame, group: str, slope: str | None, weights: dict[str, Column]
) -> tuple[dict[str, MixedFit], DataFrame]:
    """One model per resample (``weights``: how often it holds a row), from one pass over the rows.

    Also the random effects as a table with one row per resample and group: id, g,
    intercept, slope. It is written to the checkpoint folder, so that a lost
    executor or driver step refits nothing.
    """
    table, design = _group_table(prepared, df, group, slope, weights)
    table = cut_lineage(table)
    found = _search(table, design)
    ids = list(weights)
    missing = [i for k, i in enumerate(ids) if k not in found]
    if missing:
        raise ValueError(f"no complete row to fit: {', '.join(missing)}")
    fits = {i: found[k].fit() for k, i in enumerate(ids)}
    for i, fit in fits.items():
        if not fit.converged:
            warnings.warn(f"the variance search has not converged after {fit.iterations} rounds ({i})", stacklevel=2)
    kind = table.schema["g"].dataType.simpleString()
    kernel = _effects_kernel({k: (_factor(s.accepted)[0], s.solved[0]) for k, s in found.items()}, design)
    effects = table.mapInArrow(kernel, f"k int, g {kind}, intercept double, slope double")
    names = F.array(*[F.lit(i) for i in ids])
    return fits, cut_lineage(effects.select(F.get(names, "k").alias("id"), "g", "intercept", "slope"))


def fit_mixed(prepared: PreparedRecipe, df: DataFrame, group: str, slope: str | None = None) -> MixedFit:
    """Fixed effects from the recipe, random intercept and ``slope`` by ``group``."""
    return fit_mixed_set(prepared, df, group, slope, {"all": F.lit(1)})[0]["all"]
