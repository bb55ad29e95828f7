"""Model specifications and their fits on a prepared recipe."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldspark.functions.constants import array_constant, text_constant
from foldspark.operators.gram import MAX_WIDTH, Coding, Gram, Member, grams
from foldspark.operators.linear import LinearFit, elastic_net, solve
from foldspark.operators.logistic import ClassMember, fit_logistic, fit_logistic_set
from foldspark.operators.mixed import MixedFit, fit_mixed_set
from foldspark.operators.recipe import Codes, CodeTable, Feature, PreparedRecipe, _predictors
from foldspark.operators.survival import SurvivalFit, fit_survival
from foldspark.session import cached

_MAX_CLASSES = 100


@dataclass(frozen=True)
class ModelSpec:
    """Model type, engine and arguments; nothing is computed until it is fitted."""

    kind: str
    mode: str
    engine: str
    arguments: tuple[tuple[str, object], ...] = ()

    def get(self, name: str, default=None):
        return dict(self.arguments).get(name, default)

    def set_engine(self, engine: str) -> "ModelSpec":
        if engine not in _ENGINES[self.kind]:
            raise ValueError(f"{self.kind} has no engine {engine}")
        return replace(self, engine=engine)

    def set_mode(self, mode: str) -> "ModelSpec":
        if mode != self.mode:
            raise ValueError(f"{self.kind} supports only {self.mode}")
        return self

    def with_arguments(self, **changes) -> "ModelSpec":
        return replace(self, arguments=tuple({**dict(self.arguments), **changes}.items()))


_ENGINES = {
    "linear_reg": ("gram", "penalized"),
    "decision_tree": ("spark_tree",),
    "rand_forest": ("spark_forest",),
    "logistic_reg": ("newton", "spark_logistic"),
    "multinom_reg": ("newton", "spark_logistic"),
    "mixed_reg": ("reml",),
    "survival_reg": ("weibull",),
}


#: Engines that need only the cross-products.
LINEAR_ENGINES = ("gram", "penalized")

TREE_ENGINES = ("spark_tree", "spark_forest")


def linear_reg(penalty: float | None = None, mixture: float = 1.0) -> ModelSpec:
    """Least squares; with a penalty, elastic net (mixture 1 is the lasso)."""
    engine = "gram" if penalty is None else "penalized"
    return ModelSpec("linear_reg", "regression", engine, (("penalty", penalty), ("mixture", mixture)))


#: The deepest tree the underlying learner grows; nothing else bounds the depth by default.
DEEPEST = 30


def decision_tree(min_n: int = 2, max_depth: int = DEEPEST, min_gain: float = 0.0) -> ModelSpec:
    """``min_n`` bounds the rows of a leaf here, not of a node about to be split."""
    return ModelSpec(
        "decision_tree",
        "regression",
        "spark_tree",
        (("min_n", min_n), ("max_depth", max_depth), ("min_gain", min_gain)),
    )


def rand_forest(
    trees: int = 500, min_n: int = 5, mtry: int | None = None, max_depth: int = DEEPEST, seed: int = 1
) -> ModelSpec:
    arguments = (("trees", trees), ("min_n", min_n), ("mtry", mtry), ("max_depth", max_depth), ("seed", seed))
    return ModelSpec("rand_forest", "regression", "spark_forest", arguments)


def logistic_reg() -> ModelSpec:
    return ModelSpec("logistic_reg", "classification", "newton")


def multinom_reg() -> ModelSpec:
    return ModelSpec("multinom_reg", "classification", "newton")


def mixed_reg() -> ModelSpec:
    """Random effects; a workflow names the ``group`` and, if wanted, the ``slope`` beside its variables."""
    return ModelSpec("mixed_reg", "regression", "reml")


def survival_reg() -> ModelSpec:
    """Weibull survival times; a workflow names the ``event`` column (1: seen, 0: censored) and, if wanted, ``strata``."""
    return ModelSpec("survival_reg", "censored regression", "weibull")


#: What a model takes beside the design, and which of it must be named.
MODEL_TERMS = {"mixed_reg": (("group", "slope"), ("group",)), "survival_reg": (("event", "strata"), ("event",))}


# ---------------------------------------------------------------- fits

@dataclass(frozen=True)
class Layout:
    """How one resample sees a shared vector: its splines and codes, and the map to its design."""

    width: int
    curves: tuple[tuple[int, object], ...]
    table: np.ndarray
    codes: tuple[Coding, ...] = ()

    @classmethod
    def of(cls, base) -> "Layout":
        at, curves, codes, plain, sources = 0, [], [], 0, {}
        for identity, _, width, change in base:
            if isinstance(change, np.ndarray):
                plain += width
            elif isinstance(change, CodeTable):
                levels = len(change.table)
                source = sources.setdefault((identity[1], levels), at)
                codes.append(Coding(at, levels, at + 1 if width == 2 else None, source))
                plain += levels
            else:
                curves.append((at, change))
            at += width
        # summed columns: plain ones, the outcome, then every spline's terms
        maps = [c.table if isinstance(c, CodeTable) else c for _, _, _, c in base]
        terms = sum(c.shape[1] if isinstance(c, np.ndarray) else c.size for c in maps)
        table = np.zeros((plain + 1 + sum(s.size for _, s in curves), terms + 1))
        table[plain, terms] = 1.0
        row, bent, column = 0, plain + 1, 0
        for change in maps:
            if isinstance(change, np.ndarray):
                rows, columns = change.shape
                table[row : row + rows, column : column + columns] = change
                row, column = row + rows, column + columns
            else:
                table[bent : bent + change.size, column : column + change.size] = np.eye(change.size)
                bent, column = bent + change.size, column + change.size
        return cls(at + 1, tuple(curves), table, tuple(codes))


def shared_vector(base, outcome: str) -> Column:
    """The columns a layout refers to, the outcome last."""
    return F.concat(*[e[1] for e in base], F.array(F.col(outcome).cast("double")))


def fit_linear(prepared: PreparedRecipe, df: DataFrame) -> LinearFit:
    return fit_linear_set({"all": prepared}, df)["all"]


def solve_spec(spec: ModelSpec | None, sums: Gram, terms: list[str]) -> LinearFit:
    """The linear model that ``spec`` asks for, from the cross-products."""
    if spec is not None and spec.engine == "penalized":
        return elastic_net(sums, terms, spec.get("penalty"), spec.get("mixture"))
    return solve(sums, terms)


def fit_linear_set(
    prepared: dict[str, PreparedRecipe], df: DataFrame, specs: dict[str, ModelSpec] | None = None
) -> dict[str, LinearFit]:
    """Least squares, or its penalised form, of several prepared recipes from one pass over the rows."""
    specs = specs or {}
    # models of one recipe share its cross-products
    first: dict[int, str] = {}
    for name, one in prepared.items():
        first.setdefault(id(one), name)
    members, layouts = {}, {}
    for name in first.values():
        one = prepared[name]
        base = one.base(coded=True)
        layouts[name] = Layout.of(base)
        curves = {"all": layouts[name].curves} if layouts[name].curves else None
        vector = shared_vector(base, one.recipe.outcome)
        members[name] = Member(vector, layouts[name].width, ("all",), curves, layouts[name].codes)
    found = grams(df, {"all": F.lit(1)}, members)
    sums = {n: found[n, "all"].map(layouts[n].table) for n in first.values()}
    return {n: solve_spec(specs.get(n), sums[first[id(one)]], one.terms) for n, one in prepared.items()}


def outcome_vector(prepared: PreparedRecipe) -> Column:
    """Design and outcome as one array, the input of the cross-products."""
    outcome = F.array(F.col(prepared.recipe.outcome).cast("double"))
    return F.concat(prepared.design(), outcome)


@dataclass(frozen=True)
class LinearModel:
    """Least squares behind the common prediction interface."""

    fit: LinearFit

    def predictions(self, prepared: PreparedRecipe, kind: str) -> dict[str, Column]:
        pred = prepared.score(self.fit.estimate)
        if kind == "numeric":
            return {"pred": pred}
        if kind == "pred_int":
            low, high = self.fit.interval(pred, prepared.design())
            return {"pred": pred, "pred_lower": low, "pred_upper": high}
        raise ValueError(f"a linear model has no predictions of type {kind}")

    def predict(self, prepared, df, kind):
        return df.withColumns(self.predictions(prepared, kind))

    def tidy(self, spark: SparkSession) -> DataFrame:
        return self.fit.tidy(spark)


def class_columns(levels, scores: list[Column], kind: str) -> dict[str, Column]:
    """Probabilities or the most likely class from one linear score per level."""
    known = scores[-1]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    shifted = [F.exp(s - top) for s in scores]
    total = shifted[0]
    for s in shifted[1:]:
        total = total + s
    present = known.isNotNull()
    if kind == "prob":
        return {f"pred_{level}": F.when(present, s / total) for level, s in zip(levels, shifted)}
    if kind == "class":
        chain = F.lit(levels[0])
        for level, score in zip(levels[1:], scores[1:]):
            chain = F.when(score == top, F.lit(level)).otherwise(chain)
        # ties go to the earlier level
        if len(levels) > 1:
            chain = F.when(scores[0] == top, F.lit(levels[0])).otherwise(chain)
        return {"pred_class": F.when(present, chain)}
    raise ValueError(f"a classifier has no predictions of type {kind}")


@dataclass(frozen=True)
class ClassModel:
    """Linear scores per class turned into probabilities."""

    levels: tuple[str, ...]
    terms: tuple[str, ...]
    coefficients: np.ndarray  # one row per class after the first, intercept first
    iterations: int = 0
    converged: bool = True

    def predictions(self, prepared: PreparedRecipe, kind: str) -> dict[str, Column]:
        scores = [F.lit(0.0)] + [prepared.score(row) for row in self.coefficients]
        return class_columns(self.levels, scores, kind)

    def predict(self, prepared, df, kind):
        return df.withColumns(self.predictions(prepared, kind))

    def tidy_rows(self) -> list[tuple[str, str, float]]:
        return [
            (level, term, float(v))
            for level, row in zip(self.levels[1:], self.coefficients)
            for term, v in zip(self.terms, row)
        ]

    def tidy(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.tidy_rows(), "y_level string, term string, estimate double")


@dataclass(frozen=True)
class MixedModel:
    """Fixed effects as numbers, random effects as a table with one row per group.

    Rows are joined to their group's effects. A group that was not seen, or a null
    one, has the fixed effects only; a missing predictor, slope included, leaves the prediction missing.
    """

    fit: MixedFit
    effects: DataFrame  # g, intercept, slope
    group: str
    slope: str | None

    def predict(self, prepared, df, kind):
        if kind not in ("numeric", "population"):
            raise ValueError(f"a mixed model has no predictions of type {kind}")
        fixed = prepared.score(self.fit.fixed)
        if kind == "population":
            return df.withColumn("pred", fixed)
        own = self.effects.select(
            F.col("g").alias("__g"), F.col("intercept").alias("__b0"), F.col("slope").alias("__b1")
        )
        joined = df.join(own, F.col(self.group) == F.col("__g"), "left")
        effect = F.coalesce("__b0", F.lit(0.0))
        if self.slope is not None:
            effect = effect + F.coalesce("__b1", F.lit(0.0)) * F.col(self.slope).cast("double")
        return joined.withColumn("pred", fixed + effect).drop("__g", "__b0", "__b1")

    def tidy(self, spark: SparkSession) -> DataFrame:
        return self.fit.tidy(spark)


@dataclass(frozen=True)
class SurvivalModel:
    """Weibull survival times behind the common prediction interface.

    ``time`` is the fitted time scale exp(x'b), ``median`` the median time; a
    stratum that was not seen has no median.
    """

    fit: SurvivalFit
    strata: str | None

    def predictions(self, prepared: PreparedRecipe, kind: str) -> dict[str, Column]:
        location = prepared.score(self.fit.estimate)
        if kind in ("numeric", "time"):
            return {"pred": F.exp(location)}
        if kind == "median":
            return {"pred": F.exp(location + self.fit.scale_of(self.strata) * float(np.log(np.log(2.0))))}
        raise ValueError(f"a survival model has no predictions of type {kind}")

    def predict(self, prepared, df, kind):
        return df.withColumns(self.predictions(prepared, kind))

    def tidy(self, spark: SparkSession) -> DataFrame:
        return self.fit.tidy(spark)


@dataclass(frozen=True)
class TreeModel:
    """A tree or forest over numeric columns and level-coded nominal ones."""

    model: object
    levels: dict[str, list[str]]

    def predict(self, prepared, df, kind):
        if kind != "numeric":
            raise ValueError(f"a tree has no predictions of type {kind}")
        vector, known = tree_vector(prepared, self.levels)
        held = df.withColumns({"__known": known, "__features": vector})
        scored = self.model.transform(held)
        return scored.withColumn("pred", F.when(F.col("__known"), F.col("__pred"))).drop(
            "__known", "__features", "__pred"
        )


def tree_vector(prepared: PreparedRecipe, levels: dict[str, list[str]]) -> tuple[Column, Column]:
    """Feature vector with metadata for nominal columns, and whether it is complete."""
    parts, scalars, known = [], [], F.lit(True)
    attributes, at = {"numeric": [], "nominal": []}, 0
    for feature in _predictors(prepared.state):
        if feature.kind == "block":
            if scalars:
                parts.append(F.array(*scalars))
                scalars = []
            known = known & F.forall(feature.expr, lambda v: v.isNotNull())
            parts.append(F.transform(feature.expr, lambda v: F.coalesce(v, F.lit(0.0))))
        else:
            nominal = feature.kind == "nominal"
            value = _level_code(feature, levels[feature.columns[0]]) if nominal else feature.expr.cast("double")
            known = known & value.isNotNull()
            scalars.append(F.coalesce(value, F.lit(0.0)))
        if feature.kind == "nominal":
            own = levels[feature.columns[0]]
            attributes["nominal"].append(
                {"idx": at, "name": feature.columns[0], "vals": [*own, "(unseen)"]}
            )
            at += 1
        else:
            for name in feature.columns:
                attributes["numeric"].append({"idx": at, "name": name})
                at += 1
    if scalars:
        parts.append(F.array(*scalars))
    filled = parts[0] if len(parts) == 1 else F.concat(*parts)
    metadata = {"ml_attr": {"attrs": {k: v for k, v in attributes.items() if v}, "num_attrs": at}}
    return array_to_vector(filled).alias("__features", metadata=metadata), known


def _level_code(feature: Feature, own: list[str]) -> Column:
    """Place of a level among those seen in training, from 0; one not seen gets the code after the last."""
    if feature.codes is None:
        names, code = [None, *own], F.array_position(text_constant(own), feature.expr).cast("int")
    else:
        names, code = feature.codes.names, feature.codes.code
    place = {v: float(k) for k, v in enumerate(own)}
    return F.get(array_constant([place.get(v, float(len(own))) for v in names]), code)


def tree_levels(
    prepared: dict[str, PreparedRecipe], df: DataFrame, weights: dict[str, Column]
) -> dict[str, dict[str, list[str]]]:
    """Levels of the nominal predictors in every subset of the rows, from one count per column."""
    found: dict[str, dict[str, list[str]]] = {i: {} for i in weights}
    groups: dict[tuple[str, int], tuple[Column, list[str]]] = {}
    for i in weights:
        for f in _predictors(prepared[i].state):
            if f.kind == "nominal":
                groups.setdefault((f.columns[0], id(f.expr)), (f.expr, []))[1].append(i)
    for (column, _), (expr, ids) in groups.items():
        marks = [f"n{k}" for k in range(len(ids))]
        seen = (
            df.where(expr.isNotNull())
            .groupBy(expr.alias("level"))
            .agg(*[F.max((weights[i] > 0).cast("int")).alias(m) for i, m in zip(ids, marks)])
            .persist()
        )
        sizes = seen.agg(*[F.sum(m).alias(m) for m in marks]).first()
        if any((n or 0) > MAX_WIDTH for n in sizes):
            seen.unpersist()
            raise ValueError(f"more than {MAX_WIDTH} levels")
        # at most so many levels of every subset
        rows = seen.where(F.greatest(F.lit(0), *marks) > 0).collect()
        seen.unpersist()
        for i, m in zip(ids, marks):
            found[i][column] = sorted(r["level"] for r in rows if r[m])
    return found


def tree_features(
    prepared: dict[str, PreparedRecipe], levels: dict[str, dict[str, list[str]]]
) -> tuple[dict[str, Column], dict[str, PreparedRecipe]]:
    """Every distinct predictor of some recipes as a column to keep, and the recipes over those columns.

    A nominal predictor is kept as its place among the levels of all recipes, 0 for any other.
    """
    columns: dict[str, Column] = {}
    place: dict[tuple, tuple[str, list[str]]] = {}
    over: dict[str, PreparedRecipe] = {}
    union: dict[int, set[str]] = {}
    for i, one in prepared.items():
        for f in _predictors(one.state):
            if f.kind == "nominal":
                union.setdefault(id(f.expr), set()).update(levels[i][f.columns[0]])
    for i, one in prepared.items():
        state = dict(one.state)
        for key, f in one.state.items():
            if f.role != "predictor":
                continue
            if id(f.expr) not in place:
                name, known = f"__feature_{len(place)}", sorted(union.get(id(f.expr), ()))
                if f.kind == "nominal":
                    columns[name] = F.array_position(text_constant(known), f.expr).cast("int")
                else:
                    columns[name] = f.expr if f.kind == "block" else f.expr.cast("double")
                place[id(f.expr)] = (name, known)
            name, known = place[id(f.expr)]
            codes = None
            if f.kind == "nominal":
                own = set(levels[i][f.columns[0]])
                codes = Codes(tuple(known), F.col(name), (None, *[v if v in own else None for v in known]))
            state[key] = replace(f, expr=F.col(name), codes=codes, lookup=None, curve=None)
        over[i] = replace(one, state=state)
    return columns, over


def _levels_of(df: DataFrame, expr: Column, limit: int) -> list[str]:
    rows = df.where(expr.isNotNull()).select(expr.alias("v")).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} levels")
    return sorted(row["v"] for row in rows)


def fit_tree(
    spec: ModelSpec, prepared: PreparedRecipe, df: DataFrame, levels: dict[str, list[str]] | None = None
) -> TreeModel:
    """``levels`` are those of the nominal predictors in ``df``, where they are known already."""
    if levels is None:
        levels = tree_levels({"all": prepared}, df, {"all": F.lit(1)})["all"]
    vector, known = tree_vector(prepared, levels)
    outcome = F.col(prepared.recipe.outcome).cast("double")
    rows = df.select(vector, outcome.alias("__label"), known.alias("__known"))
    rows = rows.where("__known and __label is not null").drop("__known")
    bins = max([32, *[len(v) + 1 for v in levels.values()]])
    shared = {
        "featuresCol": "__features",
        "labelCol": "__label",
        "predictionCol": "__pred",
        "maxBins": bins,
        "maxDepth": spec.get("max_depth"),
        "minInstancesPerNode": spec.get("min_n"),
    }
    if spec.engine == "spark_tree":
        learner = DecisionTreeRegressor(minInfoGain=spec.get("min_gain"), **shared)
    else:
        mtry = spec.get("mtry")
        learner = RandomForestRegressor(
            numTrees=spec.get("trees"),
            featureSubsetStrategy="sqrt" if mtry is None else str(int(mtry)),
            seed=spec.get("seed"),
            **shared,
        )
    return TreeModel(learner.fit(rows), levels)


def _complete_rows(prepared: PreparedRecipe, df: DataFrame, outcome: Column) -> DataFrame:
    rows = df.select(prepared.design().alias("d"), outcome.alias("label"))
    rows = rows.where(F.col("label").isNotNull() & F.forall("d", lambda v: v.isNotNull()))
    return rows.select(array_to_vector("d").alias("features"), "label")


def fit_classes(prepared: PreparedRecipe, df: DataFrame, binary: bool, engine: str) -> ClassModel:
    """Logistic regression, two or more classes, coded against the first level."""
    outcome = F.col(prepared.recipe.outcome).cast("string")
    levels = outcome_levels(df, outcome)
    if binary and len(levels) != 2:
        raise ValueError(f"a logistic regression needs two levels, found {len(levels)}")
    label = class_label(outcome, levels)
    if engine == "newton":
        rows = df.select(prepared.design().alias("d"), label.cast("int").alias("label"))
        with cached(rows.where("label is not null")) as known:
            table, iterations, converged = fit_logistic(known, len(prepared.terms), len(levels))
    else:
        table, iterations, converged = _spark_logistic(_complete_rows(prepared, df, label), binary)
    return ClassModel(tuple(levels), ("(Intercept)", *prepared.terms), table, iterations, converged)


def outcome_levels(df: DataFrame, outcome: Column) -> list[str]:
    return _levels_of(df, outcome, _MAX_CLASSES)


def class_label(outcome: Column, levels: list[str]) -> Column:
    """Place of the outcome among its levels, from 0."""
    return F.array_position(text_constant(levels), outcome).cast("double") - 1.0


def fit_class_set(
    specs: dict[str, ModelSpec],
    prepared: dict[tuple[str, str], PreparedRecipe],
    df: DataFrame,
    label: Column,
    levels: list[str],
    weights: dict[str, Column],
) -> dict[tuple[str, str], ClassModel]:
    """Classifiers of several specs over several subsets (``weights``) of the rows, in common passes.

    A recipe whose subsets see the same columns through linear maps brings its columns once.
    """
    members: dict[str, ClassMember] = {}
    places: dict[tuple[str, str], tuple[str, str]] = {}
    for n, spec in specs.items():
        if spec.kind == "logistic_reg" and len(levels) != 2:
            raise ValueError(f"a logistic regression needs two levels, found {len(levels)}")
        if spec.engine != "newton":
            raise ValueError(f"the engine {spec.engine} is not fitted over resamples")
        bases = {i: prepared[n, i].base() for i in weights}
        first = next(iter(bases.values()))
        plain = all(isinstance(e[3], np.ndarray) for b in bases.values() for e in b)
        if first and plain and all([e[0] for e in b] == [e[0] for e in first] for b in bases.values()):
            layouts = {i: Layout.of(b) for i, b in bases.items()}
            width = layouts[next(iter(layouts))].width - 1
            maps = {i: lay.table[:width, :-1] for i, lay in layouts.items()}
            members[n] = ClassMember(F.concat(*[e[1] for e in first]), width, label, len(levels), weights, maps)
            places |= {(n, i): (n, i) for i in weights}
        else:
            for i, w in weights.items():
                one = prepared[n, i]
                members[f"{n}|{i}"] = ClassMember(one.design(), len(one.terms), label, len(levels), {i: w})
                places[n, i] = (f"{n}|{i}", i)
    found = fit_logistic_set(df, members)
    return {
        key: ClassModel(
            tuple(levels), ("(Intercept)", *prepared[key].terms), found[at].beta, found[at].iterations, found[at].converged
        )
        for key, at in places.items()
    }


def _spark_logistic(rows: DataFrame, binary: bool) -> tuple[np.ndarray, int, bool]:
    """The built-in quasi-Newton learner: many cheap passes, for very wide designs."""
    learner = LogisticRegression(
        regParam=0.0, maxIter=200, tol=1e-10, family="binomial" if binary else "multinomial"
    )
    with cached(rows) as known:
        model = learner.fit(known)
    steps = int(model.summary.totalIterations)
    done = steps < learner.getMaxIter()
    if binary:
        return np.concatenate([[model.intercept], model.coefficients.toArray()])[None, :], steps, done
    whole = np.hstack([model.interceptVector.toArray()[:, None], model.coefficientMatrix.toArray()])
    return whole[1:] - whole[0], steps, done


def fit_mixed_models(
    prepared: PreparedRecipe, df: DataFrame, terms: dict[str, str], weights: dict[str, Column]
) -> dict[str, MixedModel]:
    """Mixed models of several subsets of the rows, searched together."""
    slope = terms.get("slope")
    fits, effects = fit_mixed_set(prepared, df, terms["group"], slope, weights)
    return {i: MixedModel(fit, effects.where(F.col("id") == i).drop("id"), terms["group"], slope) for i, fit in fits.items()}


def fit_survival_model(prepared: PreparedRecipe, df: DataFrame, terms: dict[str, str]) -> SurvivalModel:
    names = [f"x{i}" for i in range(len(prepared.terms))]
    strata = terms.get("strata")
    rows = df.select(
        F.col(prepared.recipe.outcome).alias("time"),
        F.col(terms["event"]).alias("event"),
        *([] if strata is None else [F.col(strata).alias("strata")]),
        prepared.design().alias("d"),
    ).where("time > 0")
    rows = rows.select("*", *[F.get("d", F.lit(i)).alias(n) for i, n in enumerate(names)]).drop("d")
    fit = fit_survival(rows, "time", "event", names, None if strata is None else "strata")
    return SurvivalModel(replace(fit, terms=("(Intercept)", *prepared.terms)), strata)


def fit_model(spec: ModelSpec, prepared: PreparedRecipe, df: DataFrame, terms: dict[str, str] | None = None):
    """``terms`` names the columns that the model takes beside its design (``MODEL_TERMS``)."""
    if spec.kind == "mixed_reg":
        return fit_mixed_models(prepared, df, terms, {"all": F.lit(1)})["all"]
    if spec.kind == "survival_reg":
        return fit_survival_model(prepared, df, terms)
    if spec.engine in LINEAR_ENGINES:
        return LinearModel(fit_linear_set({"all": prepared}, df, {"all": spec})["all"])
    if spec.mode == "classification":
        return fit_classes(prepared, df, spec.kind == "logistic_reg", spec.engine)
    return fit_tree(spec, prepared, df)
