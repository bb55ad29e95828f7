"""Feature engineering recipes: estimate on training rows, apply anywhere.

A recipe is an immutable list of steps. Preparing it turns every feature into a
Column expression over the raw table; applying it is therefore one projection,
on batch or streaming rows. Steps that need statistics get them for all
resamples at once: a resample is a weight column, and one aggregation returns the
numbers of every resample.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldspark.functions.constants import array_constant, text_constant
from foldspark.operators.gram import MAX_WIDTH, Gram, Member, grams
from foldspark.operators.linear import dot, dot_columns
from foldspark.operators.ordered import exact_quantiles
from foldspark.operators.splines import NaturalSpline, knot_probabilities

OTHER = "other"

# A selector names columns given the current state of one prepared recipe.
Selector = Callable[["State"], list[str]]


@dataclass(frozen=True)
class Codes:
    """A nominal column as a code all resamples share: 0 for a level outside ``levels``."""

    levels: tuple[str, ...]
    code: Column
    names: tuple[str | None, ...]  # what this resample calls codes 0, 1, ...


@dataclass(frozen=True)
class Lookup:
    """A block whose values are rows of a small table, times an optional factor.

    The table belongs to one resample. Code and factor are shared, so every
    resample's block is a linear map of the same 0/1 columns.
    """

    code: Column
    table: np.ndarray  # one row per code; NaN where the level is unknown
    factor: Column | None = None


@dataclass(frozen=True)
class CodeTable:
    """The change from the 0/1 columns of a code to a block's columns."""

    table: np.ndarray


@dataclass(frozen=True)
class Feature:
    """A feature: one scalar column, or a block of columns held as one array."""

    columns: tuple[str, ...]
    expr: Column
    kind: str  # numeric, nominal or block
    role: str = "predictor"
    codes: Codes | None = None
    lookup: Lookup | None = None
    curve: tuple[Column, NaturalSpline] | None = None


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also inside array functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _lookup_feature(columns: tuple[str, ...], lookup: Lookup, role: str) -> Feature:
    """The block as an expression: one array access per row."""
    rows = [[None if np.isnan(v) else v for v in row] for row in lookup.table.tolist()]
    unknown = [None] * len(columns)
    # an extra last row stands for a missing value
    at = F.coalesce(lookup.code, F.lit(len(rows))).cast("int")
    block = F.get(array_constant([*rows, unknown], "array<array<double>>"), at)
    if lookup.factor is not None:
        block = _bind(lookup.factor, lambda x: F.transform(block, lambda v: v * x))
    return Feature(columns, block, "block", role, None, lookup)


State = dict[str, Feature]


def _predictors(state: State) -> list[Feature]:
    return [f for f in state.values() if f.role == "predictor"]


# ---------------------------------------------------------------- selectors

def all_nominal_predictors() -> Selector:
    return lambda state: [f.columns[0] for f in _predictors(state) if f.kind == "nominal"]


def all_numeric_predictors() -> Selector:
    return lambda state: [c for f in _predictors(state) if f.kind != "nominal" for c in f.columns]


def starts_with(prefix: str) -> Selector:
    return lambda state: [c for f in _predictors(state) for c in f.columns if c.startswith(prefix)]


def contains(text: str) -> Selector:
    return lambda state: [c for f in _predictors(state) for c in f.columns if text in c]


def _select(state: State, choice: tuple) -> list[str]:
    names: list[str] = []
    for item in choice:
        found = item(state) if callable(item) else [item]
        for name in found:
            if name not in names:
                names.append(name)
    known = {c for f in state.values() for c in f.columns}
    missing = [n for n in names if n not in known]
    if missing:
        raise ValueError(f"not a column of the recipe: {', '.join(missing)}")
    return names


def _scalar(state: State, column: str) -> Column:
    """One column of the state as a scalar expression."""
    for feature in state.values():
        if column in feature.columns:
            if feature.kind == "block":
                return F.get(feature.expr, F.lit(feature.columns.index(column)))
            return feature.expr
    raise ValueError(f"not a column of the recipe: {column}")


def _vector(state: State, columns: list[str]) -> Column:
    """Several columns as one array, keeping whole blocks whole."""
    for feature in state.values():
        if feature.kind == "block" and list(feature.columns) == columns:
            return feature.expr
    return F.array(*[_scalar(state, c).cast("double") for c in columns])


# ---------------------------------------------------------------- steps

@dataclass(frozen=True)
class Step:
    """Base of all steps: ``prepare`` rewrites the state of every resample."""

    choice: tuple = ()
    id: str = ""

    name = "step"
    trained = False  # whether the step learns numbers from the rows

    def prepare(self, df: DataFrame, states: dict[str, State], weights: dict[str, Column]) -> dict[str, dict]:
        """Change ``states`` in place; return the learned parameters per resample."""
        raise NotImplementedError


def _same_expression(states: dict[str, State], key: str) -> list[list[str]]:
    """Resamples grouped by whether they share the very same feature expression."""
    groups: dict[int, list[str]] = {}
    for name, state in states.items():
        groups.setdefault(id(state[key].expr), []).append(name)
    return list(groups.values())


@dataclass(frozen=True)
class Log(Step):
    """Logarithm of value + offset; not positive gives NULL."""

    base: float = float(np.e)
    offset: float = 0.0
    name = "log"

    def prepare(self, df, states, weights):
        def logged(feature: Feature) -> Feature:
            shifted = feature.expr.cast("double") + F.lit(float(self.offset))
            value = F.log10(shifted) if self.base == 10 else F.log(shifted) / float(np.log(self.base))
            return replace(feature, expr=F.when(shifted > 0, value))

        return _rewrite(states, self.choice, logged)


@dataclass(frozen=True)
class Mutate(Step):
    """New or replaced columns computed from the others."""

    rules: tuple = ()
    name = "mutate"

    def prepare(self, df, states, weights):
        made: dict[tuple, tuple[State, Feature]] = {}
        for state in states.values():
            for target, (rule, kind) in self.rules:
                marker = (target, tuple(id(f.expr) for f in state.values()))
                if marker not in made:
                    before = dict(state)
                    expr = rule(lambda column, s=before: _scalar(s, column))
                    role = state[target].role if target in state else "predictor"
                    made[marker] = (before, Feature((target,), expr, kind, role))
                state[target] = made[marker][1]
        return {name: {} for name in states}


@dataclass(frozen=True)
class Other(Step):
    """Pool levels whose share is below the threshold; unseen levels join them."""

    threshold: float = 0.05
    name = "other"
    trained = True

    def prepare(self, df, states, weights):
        if not 0 < self.threshold <= 1:
            raise ValueError("the threshold is a share in (0, 1]")
        learned: dict[str, dict] = {name: {} for name in states}
        for column in _select(next(iter(states.values())), self.choice):
            for names in _same_expression(states, column):
                feature = states[names[0]][column]
                kept = self._kept(df, feature.expr, {n: weights[n] for n in names})
                union = sorted({level for keep, _ in kept.values() for level in keep})
                code = F.array_position(text_constant(union), feature.expr).cast("int")
                made: dict[tuple, Feature] = {}
                for name in names:
                    keep, pooled = kept[name]
                    key = (tuple(keep), pooled)
                    if key not in made:
                        rest = OTHER if pooled else None
                        called = (rest, *[v if v in keep else rest for v in union])
                        expr = F.when(F.array_contains(text_constant(keep), feature.expr), feature.expr).when(
                            feature.expr.isNotNull(), F.lit(OTHER)
                        )
                        made[key] = replace(feature, expr=expr, codes=Codes(tuple(union), code, called))
                    states[name][column] = made[key]
                    learned[name][column] = keep
        return learned

    def _kept(self, df, expr, weights) -> dict[str, tuple[list[str], bool]]:
        """Retained levels per resample: at most 1 / threshold of them each."""
        names = list(weights)
        columns = [f"n{i}" for i in range(len(names))]
        # one pass over the rows; totals and frequent levels both come from the counts
        counted = (
            df.where(expr.isNotNull())
            .groupBy(expr.alias("level"))
            .agg(*[F.sum(weights[n]).cast("double").alias(c) for n, c in zip(names, columns)])
            .persist()
        )
        sums = counted.agg(
            *[F.sum(c).alias(f"t_{c}") for c in columns],
            *[F.sum((F.col(c) > 0).cast("long")).alias(f"k_{c}") for c in columns],
        ).first()
        floors = {c: (sums[f"t_{c}"] or 0.0) * self.threshold for c in columns}
        frequent = F.lit(False)
        for c in columns:
            frequent = frequent | ((F.col(c) > 0) & (F.col(c) >= floors[c]))
        rows = counted.where(frequent).collect()
        counted.unpersist()
        result = {}
        for n, c in zip(names, columns):
            keep = sorted(r["level"] for r in rows if r[c] > 0 and r[c] >= floors[c])
            result[n] = (keep, len(keep) < (sums[f"k_{c}"] or 0))
        return result


@dataclass(frozen=True)
class Dummy(Step):
    """0/1 columns for every level but the alphabetically first."""

    name = "dummy"
    trained = True

    def prepare(self, df, states, weights):
        learned: dict[str, dict] = {name: {} for name in states}
        for column in _select(next(iter(states.values())), self.choice):
            for names in _same_expression(states, column):
                first = states[names[0]][column]
                if first.codes is None:
                    levels = self._levels(df, first.expr, {n: weights[n] for n in names})
                    union = sorted({v for own in levels.values() for v in own})
                    code = F.array_position(text_constant(union), first.expr).cast("int")
                    coded = {
                        n: Codes(tuple(union), code, (None, *[v if v in levels[n] else None for v in union]))
                        for n in names
                    }
                else:
                    coded = {n: states[n][column].codes for n in names}
                built: dict[tuple, Feature] = {}
                for name in names:
                    codes = coded[name]
                    if codes.names not in built:
                        built[codes.names] = self._block(column, first, codes)
                    states[name][column] = built[codes.names]
                    learned[name][column] = _ordered(codes)
        return learned

    @staticmethod
    def _block(column: str, feature: Feature, codes: Codes) -> Feature:
        shown = _ordered(codes)[1:]
        # a level never seen in training has no dummy values
        table = np.array(
            [[np.nan if name is None else float(name == v) for v in shown] for name in codes.names]
        ).reshape(len(codes.names), len(shown))
        made = tuple(f"{column}_{v}" for v in shown)
        return _lookup_feature(made, Lookup(codes.code, table), feature.role)

    @staticmethod
    def _levels(df, expr, weights) -> dict[str, list[str]]:
        names = list(weights)
        seen = (
            df.where(expr.isNotNull())
            .groupBy(expr.alias("level"))
            .agg(*[F.max((weights[n] > 0).cast("int")).alias(f"n{i}") for i, n in enumerate(names)])
            .limit(MAX_WIDTH + 1)
            .collect()
        )
        if len(seen) > MAX_WIDTH:
            raise ValueError(f"more than {MAX_WIDTH} levels: pool them before making dummies")
        return {
            n: sorted(r["level"] for r in seen if r[f"n{i}"] == 1) for i, n in enumerate(names)
        }


def _ordered(codes: Codes) -> list[str]:
    """Level names in alphabetical order, the pooled one last."""
    names = {n for n in codes.names if n is not None}
    return sorted(names - {OTHER}) + ([OTHER] if OTHER in names else [])


@dataclass(frozen=True)
class Interact(Step):
    """Products of every column of one selection with every column of another."""

    right: tuple = ()
    name = "interact"

    def prepare(self, df, states, weights):
        shared: dict[tuple, Column] = {}
        for state in states.values():
            for a in _select(state, self.choice):
                others = [b for b in _select(state, self.right) if b != a]
                if not others:
                    continue
                source = next(f for f in state.values() if a in f.columns)
                marker = (id(source.expr), a)
                factor = shared.setdefault(marker, _scalar(state, a).cast("double"))
                made = tuple(f"{a}_x_{b}" for b in others)
                whole = next(
                    (f for f in state.values() if list(f.columns) == others and f.lookup is not None), None
                )
                if whole is not None and whole.lookup.factor is None:
                    lookup = replace(whole.lookup, factor=factor)
                    feature = _lookup_feature(made, lookup, "predictor")
                else:
                    feature = Feature(made, _scaled(_vector(state, others), factor), "block")
                state[f"{a}_x_{'+'.join(others)}"] = feature
        return {name: {} for name in states}


@dataclass(frozen=True)
class Spline(Step):
    """Natural cubic spline terms with knots at training quantiles."""

    deg_free: int = 2
    name = "ns"
    trained = True

    def prepare(self, df, states, weights):
        learned: dict[str, dict] = {name: {} for name in states}
        for column in _select(next(iter(states.values())), self.choice):
            for names in _same_expression(states, column):
                feature = states[names[0]][column]
                quantiles = exact_quantiles(
                    df.withColumn("__spline", feature.expr.cast("double")),
                    "__spline",
                    knot_probabilities(self.deg_free),
                    {n: weights[n] for n in names},
                )
                for name in names:
                    spline = NaturalSpline(quantiles[name])
                    width = len(str(spline.size))
                    made = tuple(f"{column}_ns_{i:0{width}d}" for i in range(1, spline.size + 1))
                    states[name][column] = Feature(
                        made,
                        spline.column(feature.expr),
                        "block",
                        feature.role,
                        curve=(feature.expr, spline),
                    )
                    learned[name][column] = quantiles[name]
        return learned


@dataclass(frozen=True)
class Normalize(Step):
    """Centre and scale by the training mean and n - 1 standard deviation."""

    name = "normalize"
    trained = True

    def prepare(self, df, states, weights):
        columns = {n: _select(s, self.choice) for n, s in states.items()}
        stats = _moments(df, states, weights, columns)
        learned = {}
        for name, state in states.items():
            mean = stats[name].mean
            spread = np.sqrt(np.diag(stats[name].cross) / (stats[name].n - 1))
            learned[name] = {
                c: (float(m), float(s)) for c, m, s in zip(columns[name], mean, spread)
            }
            for column, (m, s) in learned[name].items():
                scaled = (_scalar(state, column).cast("double") - m) / (s if s > 0 else 1.0)
                state[column] = replace(state[column], expr=scaled)
        return learned


@dataclass(frozen=True)
class Pca(Step):
    """Principal components, as many as reach the share of variance."""

    threshold: float = 0.95
    prefix: str = "PC"
    name = "pca"
    trained = True

    def prepare(self, df, states, weights):
        columns = {n: _select(s, self.choice) for n, s in states.items()}
        stats = _moments(df, states, weights, columns)
        learned = {}
        for name, state in states.items():
            values, vectors = np.linalg.eigh(stats[name].cross / (stats[name].n - 1))
            order = np.argsort(values)[::-1]
            values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
            share = np.cumsum(values) / values.sum()
            kept = int(np.argmax(share >= self.threshold - 1e-12)) + 1
            # an eigenvector's sign is arbitrary: its largest entry is made positive
            lead = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
            vectors = vectors * np.where(lead < 0, -1.0, 1.0)
            source = _vector(state, columns[name])
            loadings = array_constant(vectors[:, :kept].T.tolist(), "array<array<double>>")
            scores = _projected(loadings, source)
            for column in columns[name]:
                _drop(state, column)
            width = len(str(kept))
            made = tuple(f"{self.prefix}{i:0{width}d}" for i in range(1, kept + 1))
            state[self.prefix] = Feature(made, scores, "block")
            learned[name] = {"variance": values.tolist(), "share": share.tolist(), "kept": kept}
        return learned


@dataclass(frozen=True)
class Remove(Step):
    name = "rm"

    def prepare(self, df, states, weights):
        for state in states.values():
            for column in _select(state, self.choice):
                _drop(state, column)
        return {name: {} for name in states}


def _scaled(vector: Column, factor: Column) -> Column:
    return _bind(factor, lambda x: F.transform(vector, lambda v: v * x))


def _projected(loadings: Column, vector: Column) -> Column:
    return _bind(vector, lambda x: F.transform(loadings, lambda row: dot_columns(row, x)))


def _drop(state: State, column: str) -> None:
    for key, feature in list(state.items()):
        if column in feature.columns:
            if len(feature.columns) > 1:
                left = [c for c in feature.columns if c != column]
                state[key] = replace(
                    feature, columns=tuple(left), expr=_vector(state, left), lookup=None, curve=None
                )
            else:
                del state[key]
            return


def _rewrite(states, choice, change):
    """Apply one change of a feature, sharing the expression between resamples."""
    done: dict[int, tuple[Feature, Feature]] = {}  # the old feature is held: its id must stay taken
    for state in states.values():
        for column in _select(state, choice):
            marker = id(state[column].expr)
            if marker not in done:
                done[marker] = (state[column], change(state[column]))
            state[column] = done[marker][1]
    return {name: {} for name in states}


def _moments(df, states, weights, columns) -> dict[str, Gram]:
    """Means and centred cross-products of some columns, for every resample."""
    names = list(states)
    sources = {n: [id(f.expr) for f in s.values() if set(f.columns) & set(columns[n])] for n, s in states.items()}
    if all(sources[n] == sources[names[0]] for n in names):
        member = Member(_vector(states[names[0]], columns[names[0]]), len(columns[names[0]]), tuple(names))
        found = grams(df, weights, {"shared": member})
        return {n: found["shared", n] for n in names}
    members = {
        n: Member(_vector(states[n], columns[n]), len(columns[n]), (n,)) for n in names
    }
    found = grams(df, weights, members)
    return {n: found[n, n] for n in names}


# ---------------------------------------------------------------- recipe

@dataclass(frozen=True)
class Recipe:
    """Outcome, predictors with their kinds, other roles, and steps."""

    outcome: str
    features: tuple[tuple[str, str, str], ...]  # (column, kind, role)
    steps: tuple[Step, ...] = ()

    @classmethod
    def of(cls, df: DataFrame, outcome: str, predictors: list[str] | None = None) -> "Recipe":
        """``predictors=None`` means every other column."""
        types = dict(df.dtypes)
        names = predictors if predictors is not None else [c for c in df.columns if c != outcome]
        unknown = [c for c in [outcome, *names] if c not in types]
        if unknown:
            raise ValueError(f"not a column of the table: {', '.join(unknown)}")
        kinds = [(c, _kind(types[c]), "predictor") for c in names]
        return cls(outcome, tuple(kinds))

    def add(self, step: Step) -> "Recipe":
        number = len(self.steps) + 1
        named = step if step.id else replace(step, id=f"{step.name}_{number}")
        return replace(self, steps=(*self.steps, named))

    def step_log(self, *columns, base: float = float(np.e), offset: float = 0.0, id: str = "") -> "Recipe":
        return self.add(Log(columns, id, base, offset))

    def step_mutate(self, id: str = "", kind: str = "nominal", **rules) -> "Recipe":
        """Each rule maps an accessor of current columns to a Column."""
        return self.add(Mutate((), id, tuple((c, (r, kind)) for c, r in rules.items())))

    def step_other(self, *columns, threshold: float = 0.05, id: str = "") -> "Recipe":
        return self.add(Other(columns, id, threshold))

    def step_dummy(self, *columns, id: str = "") -> "Recipe":
        return self.add(Dummy(columns, id))

    def step_interact(self, left, right, id: str = "") -> "Recipe":
        return self.add(Interact(_many(left), id, _many(right)))

    def step_ns(self, *columns, deg_free: int = 2, id: str = "") -> "Recipe":
        return self.add(Spline(columns, id, deg_free))

    def step_normalize(self, *columns, id: str = "") -> "Recipe":
        return self.add(Normalize(columns, id))

    def step_pca(self, *columns, threshold: float = 0.95, id: str = "") -> "Recipe":
        return self.add(Pca(columns, id, threshold))

    def step_rm(self, *columns, id: str = "") -> "Recipe":
        return self.add(Remove(columns, id))

    def update_role(self, *columns: str, new_role: str) -> "Recipe":
        """Give columns another role; models use only predictors."""
        known = {c for c, _, _ in self.features}
        missing = [c for c in columns if c not in known]
        if missing:
            raise ValueError(f"not a column of the recipe: {', '.join(missing)}")
        changed = tuple(
            (c, k, new_role if c in columns else r) for c, k, r in self.features
        )
        return replace(self, features=changed)

    @property
    def raw_columns(self) -> list[str]:
        return [c for c, _, _ in self.features]

    @property
    def is_trained(self) -> bool:
        """Whether any step learns from the rows."""
        return any(step.trained for step in self.steps)

    def tidy(self, spark: SparkSession) -> DataFrame:
        """The steps as a table."""
        rows = [(i, s.name, s.id) for i, s in enumerate(self.steps, start=1)]
        return spark.createDataFrame(rows, "number int, type string, id string")

    def prep(self, df: DataFrame) -> "PreparedRecipe":
        return self.prep_resamples(df, {"all": F.lit(1)})["all"]

    def prep_resamples(
        self, df: DataFrame, weights: dict[str, Column], begun: dict[tuple, tuple] | None = None
    ) -> dict[str, "PreparedRecipe"]:
        """Estimate every step for every resample, one aggregation per step.

        ``begun`` holds what other recipes over the same rows and resamples have estimated: steps that
        they begin with as well are not estimated again.
        """
        begun = {} if begun is None else begun
        keys = [(self.features, tuple(id(s) for s in self.steps[:n])) for n in range(len(self.steps) + 1)]
        done = max((n for n, key in enumerate(keys) if key in begun), default=0)
        if keys[done] in begun:
            _, before, found = begun[keys[done]]
        else:
            base = {c: Feature((c,), F.col(c), k, r) for c, k, r in self.features}
            before, found = {name: base for name in weights}, {name: [] for name in weights}
        states = {name: dict(state) for name, state in before.items()}
        learned = {name: list(values) for name, values in found.items()}
        for n, step in enumerate(self.steps[done:], start=done + 1):
            for name, values in step.prepare(df, states, weights).items():
                learned[name].append(values)
            # the steps are held: their ids must stay taken
            copy = {name: dict(state) for name, state in states.items()}
            begun[keys[n]] = (self.steps[:n], copy, {name: list(v) for name, v in learned.items()})
        return {n: PreparedRecipe(self, states[n], tuple(learned[n])) for n in weights}


def _many(choice) -> tuple:
    return tuple(choice) if isinstance(choice, (list, tuple)) else (choice,)


def _kind(dtype: str) -> str:
    return "nominal" if dtype in ("string", "boolean") else "numeric"


@dataclass(frozen=True)
class PreparedRecipe:
    """A recipe with its numbers: pure column expressions over the raw table."""

    recipe: Recipe
    state: State
    learned: tuple[dict, ...] = field(default=())

    @property
    def terms(self) -> list[str]:
        """Names of the design columns, intercept excluded."""
        nominal = [f.columns[0] for f in _predictors(self.state) if f.kind == "nominal"]
        if nominal:
            raise ValueError(f"make dummies of the nominal predictors first: {', '.join(nominal)}")
        return [c for f in _predictors(self.state) for c in f.columns]

    def design(self) -> Column:
        """All predictors as one ``array<double>``, in the order of ``terms``."""
        parts, scalars = [], []
        for feature in _predictors(self.state):
            if feature.kind == "block":
                if scalars:
                    parts.append(F.array(*scalars))
                    scalars = []
                parts.append(feature.expr)
            else:
                scalars.append(feature.expr.cast("double"))
        if scalars:
            parts.append(F.array(*scalars))
        if not parts:
            return F.array().cast("array<double>")
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    def score(self, estimate: np.ndarray) -> Column:
        """Intercept plus the sum of coefficient times column; a missing value stays missing.

        A block of dummies is scored by looking its coefficient up, a spline by one cubic per knot interval.
        """
        coefficients = np.nan_to_num(estimate[1:])
        total, at = F.lit(float(estimate[0])), 0
        for feature in _predictors(self.state):
            own = coefficients[at : at + len(feature.columns)]
            at += len(feature.columns)
            if feature.lookup is not None:
                values = feature.lookup.table @ own
                if not len(own):  # a single level: only its presence matters
                    continue
                rows = [None if np.isnan(v) else float(v) for v in values]
                part = F.get(array_constant(rows), feature.lookup.code)
                if feature.lookup.factor is not None:
                    part = part * feature.lookup.factor
            elif feature.curve is not None:
                x, spline = feature.curve
                part = spline.score(x, own)
            elif feature.kind == "block":
                part = dot(feature.expr, own)
            else:
                part = feature.expr.cast("double") * float(own[0])
            total = total + part
        return total

    def base(self, coded: bool = False) -> list[tuple[tuple, Column, int, np.ndarray | NaturalSpline | CodeTable]]:
        """Every feature over columns that do not depend on the resample.

        Each entry is (identity, base vector, its width, change), the change being a
        linear map or a spline of a single number. Resamples whose identities are
        equal can share the base vectors. ``coded`` blocks are a code, and a factor if they have one,
        in place of their 0/1 columns.
        """
        entries = []
        for feature in _predictors(self.state):
            if feature.lookup is not None:
                look = feature.lookup
                codes = len(look.table)
                full = _lookup_feature(
                    tuple(str(i) for i in range(codes)), Lookup(look.code, np.eye(codes), look.factor), ""
                )
                identity = ("codes", id(look.code), id(look.factor))
                if coded:
                    pair = [c.cast("double") for c in (look.code, look.factor) if c is not None]
                    entries.append((identity, F.array(*pair), len(pair), CodeTable(np.nan_to_num(look.table))))
                    continue
                entries.append((identity, full.expr, codes, np.nan_to_num(look.table)))
            elif feature.curve is not None:
                x, spline = feature.curve
                entries.append((("curve", id(x)), F.array(x.cast("double")), 1, spline))
            else:
                width = len(feature.columns)
                vector = feature.expr if feature.kind == "block" else F.array(feature.expr.cast("double"))
                entries.append((("own", id(feature.expr)), vector, width, np.eye(width)))
        return entries

    def bake(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """The table of engineered columns, plus the raw columns in ``keep``."""
        blocks = {k: f for k, f in self.state.items() if f.kind == "block"}
        held = df.withColumns({f"__block_{i}": f.expr for i, f in enumerate(blocks.values())})
        at = {k: i for i, k in enumerate(blocks)}
        columns = [F.col(c) for c in (keep if keep is not None else [self.recipe.outcome])]
        for key, feature in self.state.items():
            if feature.kind == "block":
                array = F.col(f"__block_{at[key]}")
                columns += [F.get(array, F.lit(i)).alias(c) for i, c in enumerate(feature.columns)]
            else:
                columns.append(feature.expr.alias(feature.columns[0]))
        return held.select(*columns)

    def tidy(self, spark: SparkSession, number: int | None = None, id: str | None = None) -> DataFrame:
        """What one step learned: (terms, value) rows."""
        for i, step in enumerate(self.recipe.steps, start=1):
            if i == number or (id is not None and step.id == id):
                rows = []
                for column, values in self.learned[i - 1].items():
                    items = values if isinstance(values, (list, tuple)) else [values]
                    rows += [(column, str(v), step.id) for v in items]
                return spark.createDataFrame(rows, "terms string, value string, id string")
        raise ValueError("no such step")


# ---------------------------------------------------------------- formula shorthand

def formula(
    df: DataFrame,
    outcome: str,
    main: list[str] | None = None,
    pairwise: bool = False,
    log10: dict[str, float] | None = None,
) -> Recipe:
    """A recipe for main effects, optional two-way interactions and inline logs.

    ``log10`` maps a column to the offset added before the logarithm. No main
    effects gives the intercept-only model.
    """
    main = main or []
    recipe = Recipe.of(df, outcome, main)
    for column, offset in (log10 or {}).items():
        recipe = recipe.step_log(column, base=10, offset=offset)
    nominal = [c for c, k, _ in recipe.features if k == "nominal"]
    if nominal:
        recipe = recipe.step_dummy(*nominal)
    if pairwise:
        for i, a in enumerate(main):
            for b in main[i + 1 :]:
                recipe = recipe.step_interact(_columns_of(a), _columns_of(b))
    return recipe


def _columns_of(key: str) -> Selector:
    return lambda state: list(state[key].columns)


def model_matrix(df: DataFrame, recipe: Recipe, keep: list[str]) -> DataFrame:
    """The explicit design: an intercept column of ones and every term."""
    baked = recipe.prep(df).bake(df, keep)
    return baked.select(*keep, F.lit(1.0).alias("intercept"), *[c for c in baked.columns if c not in keep])
