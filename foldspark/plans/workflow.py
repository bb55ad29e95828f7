"""Workflows, workflow sets, resampled fitting and grid scoring.

All least-squares members of a set are fitted over all resamples together: a
(workflow, resample) pair is one weight column and one design, and the rows are
read once for every cross-product of the whole set.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from foldspark.operators.gram import Gram, Member, grams
from foldspark.operators.linear import TIDY_SCHEMA, LinearFit
from foldspark.operators.metrics import (
    CLASSIFICATION,
    REGRESSION,
    classification_metrics,
    regression_metrics,
    summarize_metrics,
)
from foldspark.operators.models import (
    ClassModel,
    Layout,
    LinearModel,
    ModelSpec,
    class_columns,
    class_label,
    LINEAR_ENGINES,
    MODEL_TERMS,
    TREE_ENGINES,
    fit_class_set,
    fit_linear_set,
    fit_mixed_models,
    fit_model,
    fit_tree,
    outcome_levels,
    outcome_vector,
    shared_vector,
    solve_spec,
    tree_features,
    tree_levels,
)
from foldspark.operators.mixed import MixedFit
from foldspark.operators.recipe import PreparedRecipe, Recipe
from foldspark.operators.resample import ResampleSet, Split, testing, training
from foldspark.operators.roc import roc_auc, roc_auc_pairwise
from foldspark.operators.survival import SurvivalFit
from foldspark.session import cached, hold


_FITS_AT_ONCE = 4


@dataclass(frozen=True)
class Workflow:
    """A preprocessor (a recipe, or a formula's recipe) with a model.

    ``terms`` are columns that a model takes beside its design: the group and slope
    of a mixed model, the event and strata of a survival model.
    """

    recipe: Recipe | None = None
    model: ModelSpec | None = None
    terms: tuple[tuple[str, str], ...] = ()

    def with_recipe(self, recipe: Recipe | None) -> "Workflow":
        return replace(self, recipe=recipe)

    def with_model(self, model: ModelSpec, **terms: str) -> "Workflow":
        """The model, with its special terms by name; they come before the variables are chosen."""
        known, needed = MODEL_TERMS.get(model.kind, ((), ()))
        odd = [t for t in terms if t not in known] + [t for t in needed if t not in terms]
        if odd:
            raise ValueError(f"{model.kind} takes the terms {known}, of which {needed} must be named: {', '.join(odd)}")
        return replace(self, model=model, terms=tuple(terms.items()))

    def with_variables(self, df: DataFrame, outcome: str, predictors: list[str], fixed: list[str] | None = None) -> "Workflow":
        """Variables as they are; nominal ones become dummies for linear models.

        The model's own terms are no predictors; ``fixed`` names those of the variables that are, by default all others.
        """
        special = {c for _, c in self.terms}
        predictors = [c for c in predictors if c not in special] if fixed is None else fixed
        recipe = Recipe.of(df, outcome, predictors)
        nominal = [c for c, k, _ in recipe.features if k == "nominal"]
        trees = self.model is not None and self.model.engine.startswith(("spark_tree", "spark_forest"))
        return self.with_recipe(recipe.step_dummy(*nominal) if nominal and not trees else recipe)

    @property
    def is_linear(self) -> bool:
        return self.model.engine in LINEAR_ENGINES

    @property
    def mode(self) -> str:
        return self.model.mode

    def fit(self, df: DataFrame) -> "FittedWorkflow":
        """Estimate the recipe, then the model, over one cached narrow frame."""
        with cached(df, self.columns) as rows:
            prepared = self.recipe.prep(rows)
            return FittedWorkflow(self, prepared, fit_model(self.model, prepared, rows, dict(self.terms)))

    @property
    def columns(self) -> list[str]:
        """The raw columns the workflow reads."""
        return list(dict.fromkeys([*self.recipe.raw_columns, self.recipe.outcome, *[c for _, c in self.terms]]))


@dataclass(frozen=True)
class FittedWorkflow:
    workflow: Workflow
    recipe: PreparedRecipe  # the estimated recipe
    model: object  # the fitted model

    def predict(self, df: DataFrame, kind: str = "numeric") -> DataFrame:
        """Append predictions to the rows: no positional binding is needed."""
        return self.model.predict(self.recipe, df, kind)

    def tidy(self, spark: SparkSession) -> DataFrame:
        return self.model.tidy(spark)


# ---------------------------------------------------------------- final fit

@dataclass(frozen=True)
class LastFit:
    fitted: FittedWorkflow
    predictions: DataFrame
    metrics: DataFrame


#: Metrics of a classification by default.
CLASSES = ("accuracy", "mcc", "roc_auc")


def class_metrics(
    scored: DataFrame, truth: str, levels: tuple[str, ...], metrics=CLASSES, by: list[str] | None = None, prefix: str = "pred_"
) -> DataFrame:
    """Long table of a scored classification: metrics of the classes, and areas from the probabilities.

    The event is the first level; more than two levels have the mean of the pairwise areas.
    """
    by = by or []
    unknown = set(metrics) - {*CLASSIFICATION, "roc_auc"}
    if unknown:
        raise ValueError(f"unknown classification metrics: {', '.join(sorted(unknown))}")
    tables = []
    hard = tuple(m for m in metrics if m != "roc_auc")
    if hard:
        tables.append(classification_metrics(scored, truth, f"{prefix}class", list(levels), hard, by))
    if "roc_auc" in metrics:
        # plain names: a level may hold any character
        plain = scored.select(
            *by, F.col(truth).alias("truth"), *[F.col(f"`{prefix}{v}`").alias(f"p{k}") for k, v in enumerate(levels)]
        )
        if len(levels) == 2:
            areas, estimator = roc_auc(plain, F.col("truth") == levels[0], F.col("p0"), by), "binary"
        else:
            areas, estimator = roc_auc_pairwise(plain, "truth", {v: f"p{k}" for k, v in enumerate(levels)}, by), "hand_till"
        tables.append(
            areas.select(*by, F.lit("roc_auc").alias("metric"), F.lit(estimator).alias("estimator"), F.col("estimate").cast("double"))
        )
    return reduce(lambda a, b: a.unionByName(b), tables)


def last_fit(workflow: Workflow, split: Split, metrics: tuple[str, ...] | None = None) -> LastFit:
    """Fit on the training side, score the test side once; the metrics follow the model's mode."""
    fitted = workflow.fit(training(split))
    outcome = workflow.recipe.outcome
    if workflow.mode == "classification":
        scored = testing(split).withColumns(
            fitted.model.predictions(fitted.recipe, "class") | fitted.model.predictions(fitted.recipe, "prob")
        )
        levels = fitted.model.levels
        kept = ["pred_class", *[f"`pred_{v}`" for v in levels]]
        scored = scored.select(split.key, F.col(outcome).cast("string").alias(outcome), *kept)
        return LastFit(fitted, scored, class_metrics(scored, outcome, levels, metrics or CLASSES))
    scored = fitted.predict(testing(split)).select(split.key, outcome, "pred")
    return LastFit(fitted, scored, regression_metrics(scored, outcome, "pred", metrics or REGRESSION))


# ---------------------------------------------------------------- sets

def workflow_set(preproc: dict[str, Recipe], models: dict[str, ModelSpec], cross: bool = True) -> dict[str, Workflow]:
    """Workflows by id ``<preprocessor>_<model>``; uncrossed pairs go in order."""
    if cross or len(models) == 1:
        return {
            f"{p}_{m}": Workflow(recipe, model)
            for p, recipe in preproc.items()
            for m, model in models.items()
        }
    if len(preproc) != len(models):
        raise ValueError("without crossing, give as many models as preprocessors")
    return {
        f"{p}_{m}": Workflow(recipe, model)
        for (p, recipe), (m, model) in zip(preproc.items(), models.items())
    }


def fit_set(workflows: dict[str, Workflow], df: DataFrame) -> dict[str, FittedWorkflow]:
    """Fit every workflow; all least-squares members share one pass over the rows."""
    wanted = list(dict.fromkeys(c for w in workflows.values() for c in w.columns))
    with cached(df, wanted) as rows:
        by_recipe = {id(w.recipe): w.recipe for w in workflows.values()}
        by_recipe = {k: recipe.prep(rows) for k, recipe in by_recipe.items()}
        prepared = {n: by_recipe[id(w.recipe)] for n, w in workflows.items()}
        linear = [n for n, w in workflows.items() if w.is_linear]
        models = {
            n: fit_model(w.model, prepared[n], rows, dict(w.terms))
            for n, w in workflows.items()
            if not w.is_linear
        }
        if linear:
            found = fit_linear_set({n: prepared[n] for n in linear}, rows, {n: workflows[n].model for n in linear})
            models |= {n: LinearModel(fit) for n, fit in found.items()}
        return {n: FittedWorkflow(workflows[n], prepared[n], models[n]) for n in workflows}


# ---------------------------------------------------------------- resampled fitting

@dataclass(frozen=True)
class ResampleResult:
    """Out-of-sample predictions (wflow_id, id, row, truth, pred) and fits.

    ``row`` holds the row key. A classification has the outcome's ``levels``, a text
    truth, and the columns pred_class and pred_<level> instead of pred.
    """

    predictions: DataFrame
    fits: dict[tuple[str, str], LinearFit | ClassModel | MixedFit | SurvivalFit]
    metrics: tuple[str, ...] = REGRESSION
    levels: tuple[str, ...] | None = None

    def collect_metrics(self, summarize: bool = True) -> DataFrame:
        by = ["wflow_id", "id"]
        if self.levels is not None:
            table = class_metrics(self.predictions, "truth", self.levels, self.metrics, by)
        else:
            table = regression_metrics(self.predictions, "truth", "pred", self.metrics, by)
        return summarize_metrics(table, ["wflow_id"]) if summarize else table

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """Coefficient tables of all resamples, stacked."""
        if self.levels is not None:
            rows = [(wflow, sample, *row) for (wflow, sample), fit in self.fits.items() for row in fit.tidy_rows()]
            return spark.createDataFrame(rows, "wflow_id string, id string, y_level string, term string, estimate double")
        rows = [
            (wflow, sample, *row.values())
            for (wflow, sample), fit in self.fits.items()
            if isinstance(fit, LinearFit)
            for row in fit.tidy_rows()
        ]
        return spark.createDataFrame(rows, f"wflow_id string, id string, {TIDY_SCHEMA}")

    def parameters(self, spark: SparkSession) -> DataFrame:
        """Every number of every fit as a row, whatever the learner: wflow_id, id, part, term, estimate, std_error.

        ``part`` tells the outcome level of a classifier, fixed from random effects, or locations from scales.
        """
        rows = []
        for (wflow, sample), fit in self.fits.items():
            if isinstance(fit, ClassModel):
                own = [(level, term, value, None) for level, term, value in fit.tidy_rows()]
            elif isinstance(fit, LinearFit):
                own = [("fixed", r["term"], r["estimate"], r["std_error"]) for r in fit.tidy_rows()]
            else:
                own = fit.tidy_rows()
            rows += [(wflow, sample, *r) for r in own]
        return spark.createDataFrame(
            rows, "wflow_id string, id string, part string, term string, estimate double, std_error double"
        )

    def bind(self, *others: "ResampleResult") -> "ResampleResult":
        """Append the results of other workflows of the same mode."""
        if any(o.levels != self.levels for o in others):
            raise ValueError("only results over the same outcome levels are bound")
        frames = [self.predictions, *[o.predictions for o in others]]
        fits = {k: v for r in (self, *others) for k, v in r.fits.items()}
        return replace(
            self,
            predictions=reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames),
            fits=fits,
        )


def fit_resamples(
    workflows: dict[str, Workflow] | Workflow,
    resamples: ResampleSet,
    metrics: tuple[str, ...] | None = None,
) -> ResampleResult:
    """Fit each workflow on each analysis set and predict each assessment set.

    All workflows have one mode, which the metrics follow by default.
    """
    members = workflows if isinstance(workflows, dict) else {"workflow": workflows}
    modes = {w.mode for w in members.values()}
    if len(modes) > 1:
        raise ValueError(f"the workflows have several modes: {', '.join(sorted(modes))}")
    if modes == {"classification"}:
        return _resample_classes(members, resamples, metrics or CLASSES)
    metrics = metrics or REGRESSION
    linear = {n: w for n, w in members.items() if w.is_linear}
    mixed = {n: w for n, w in members.items() if w.model.kind == "mixed_reg"}
    others = {n: w for n, w in members.items() if n not in linear and n not in mixed}
    if sum(map(bool, (linear, mixed, others))) > 1 and not resamples.df.is_cached:
        # several learners fit and score the same rows: folds are dealt once
        resamples = replace(resamples, df=hold(_narrow_frame(members, resamples)))
    results = []
    if linear:
        results.append(_resample_linear(linear, resamples, metrics))
    if mixed:
        results.append(_resample_mixed(mixed, resamples, metrics))
    if others:
        results.append(_resample_others(others, resamples, metrics))
    return results[0] if len(results) == 1 else results[0].bind(*results[1:])


def _narrow_columns(members: dict[str, Workflow], resamples: ResampleSet) -> list[str]:
    own = set(resamples.df.columns)
    wanted = [resamples.key, *[c for w in members.values() for c in w.columns]]
    marks = [c for c in resamples.df.columns if c.startswith("__")]
    return [c for c in dict.fromkeys([*wanted, *marks]) if c in own]


def _narrow_frame(members: dict[str, Workflow], resamples: ResampleSet) -> DataFrame:
    return resamples.df.select(*_narrow_columns(members, resamples))


def _resample_linear(members, resamples: ResampleSet, metrics) -> ResampleResult:
    ids = resamples.ids
    weights = {i: r.weight for i, r in resamples.resamples.items()}
    with cached(resamples.df, _narrow_columns(members, resamples)) as rows:
        prepared: dict[tuple[str, str], PreparedRecipe] = {}
        # workflows that differ in their model only share a recipe, its estimation and its cross-products;
        # recipes that begin with the same steps share the estimation of those
        begun: dict[tuple, tuple] = {}
        by_recipe: dict[int, dict[str, PreparedRecipe]] = {}
        for n, w in members.items():
            if id(w.recipe) not in by_recipe:
                if w.recipe.is_trained:
                    by_recipe[id(w.recipe)] = w.recipe.prep_resamples(rows, weights, begun)
                else:
                    by_recipe[id(w.recipe)] = dict.fromkeys(ids, w.recipe.prep(rows))
            prepared |= {(n, i): by_recipe[id(w.recipe)][i] for i in ids}
        fits = _linear_fits(rows, members, prepared, resamples, weights)

    predictions = [
        F.when(F.col("__id") == i, prepared[n, i].score(fits[n, i].estimate)) for n in members for i in ids
    ]
    scored = (
        _narrow_frame(members, resamples)
        .withColumn("__id", F.explode(resamples.assessed_in()))
        .select(
            F.col("__id").alias("id"),
            F.col(resamples.key).alias("row"),
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(n).alias("wflow_id"),
                            F.col(w.recipe.outcome).cast("double").alias("truth"),
                            F.coalesce(*predictions[k * len(ids) : (k + 1) * len(ids)]).alias("pred"),
                        )
                        for k, (n, w) in enumerate(members.items())
                    ]
                )
            ).alias("e"),
        )
        .select("e.wflow_id", "id", "row", "e.truth", "e.pred")
    )
    return ResampleResult(scored, fits, metrics)


def _linear_fits(rows, members, prepared, resamples, weights) -> dict[tuple[str, str], LinearFit]:
    """All members over all resamples, from one pass over the rows.

    A member contributes one vector of columns its resamples share; pooled levels
    are linear maps of it, codes and splines are expanded in the kernel. If the assessment
    sets partition the rows and nothing is bent per resample, the pass sums each
    fold once, and an analysis set is the total minus its fold.
    """
    ids = resamples.ids
    sides = {f"analysis|{i}": weights[i] for i in ids}
    wanted: dict[str, Member] = {}
    layouts: dict[str, list[Layout]] = {}
    by_fold = set()
    first = {}
    for n, w in members.items():
        first.setdefault(id(w.recipe), n)
    for n in first.values():
        w = members[n]
        bases = [prepared[n, i].base(coded=True) for i in ids]
        if all([e[0] for e in b] == [e[0] for e in bases[0]] for b in bases):
            vector = shared_vector(bases[0], w.recipe.outcome)
            layouts[n] = [Layout.of(b) for b in bases]
            bent = bool(layouts[n][0].curves)
            side = "analysis" if bent or resamples.fold is None else "fold"
            if side == "fold":
                by_fold.add(n)
                sides |= {f"fold|{i}": resamples.resamples[i].assess.cast("int") for i in ids}
            names = [f"{side}|{i}" for i in ids]
            curves = {s: lay.curves for s, lay in zip(names, layouts[n])} if bent else None
            wanted[n] = Member(vector, layouts[n][0].width, tuple(names), curves, layouts[n][0].codes)
        else:
            for i in ids:
                vector, width = outcome_vector(prepared[n, i]), len(prepared[n, i].terms) + 1
                wanted[f"{n}|{i}"] = Member(vector, width, (f"analysis|{i}",))
    used = {s for m in wanted.values() for s in m.subsets}
    found = grams(rows, {s: c for s, c in sides.items() if s in used}, wanted)
    sums: dict[str, dict[str, Gram]] = {}
    for n in first.values():
        if n not in layouts:
            sums[n] = {i: found[f"{n}|{i}", f"analysis|{i}"] for i in ids}
            continue
        if n in by_fold:
            parts = {i: found[n, f"fold|{i}"] for i in ids}
            total = reduce(lambda a, b: a + b, parts.values())
            own = {i: total - parts[i] for i in ids}
        else:
            own = {i: found[n, f"analysis|{i}"] for i in ids}
        sums[n] = {i: own[i].map(layout.table) for i, layout in zip(ids, layouts[n])}
    return {
        (n, i): solve_spec(w.model, sums[first[id(w.recipe)]][i], prepared[n, i].terms) for n, w in members.items() for i in ids
    }


def _resample_classes(members, resamples: ResampleSet, metrics) -> ResampleResult:
    """Classifiers: one Newton pass serves all workflows and resamples, and one scan scores them."""
    weights = {i: r.weight for i, r in resamples.resamples.items()}
    outcomes = {w.recipe.outcome for w in members.values()}
    if len(outcomes) > 1:
        raise ValueError("the workflows have several outcomes")
    outcome = F.col(outcomes.pop()).cast("string")
    with cached(resamples.df, _narrow_columns(members, resamples)) as rows:
        levels = outcome_levels(rows, outcome)
        prepared = {}
        for n, w in members.items():
            own = w.recipe.prep_resamples(rows, weights) if w.recipe.is_trained else dict.fromkeys(weights, w.recipe.prep(rows))
            prepared |= {(n, i): own[i] for i in weights}
        models = fit_class_set(
            {n: w.model for n, w in members.items()}, prepared, rows, class_label(outcome, levels), levels, weights
        )
    frame = _narrow_frame(members, resamples).withColumn("__id", F.explode(resamples.assessed_in()))
    entries = []
    for n in members:
        scores = [F.lit(0.0)] + [
            F.coalesce(*[F.when(F.col("__id") == i, prepared[n, i].score(models[n, i].coefficients[k])) for i in weights])
            for k in range(len(levels) - 1)
        ]
        entries.append(F.struct(F.lit(n).alias("wflow_id"), outcome.alias("truth"), F.array(*scores).alias("scores")))
    scored = frame.select(
        F.col("__id").alias("id"), F.col(resamples.key).alias("row"), F.explode(F.array(*entries)).alias("e")
    ).select("e.wflow_id", "id", "row", "e.truth", "e.scores")
    own_scores = [F.get("scores", F.lit(k)) for k in range(len(levels))]
    columns = class_columns(levels, own_scores, "class") | class_columns(levels, own_scores, "prob")
    return ResampleResult(scored.withColumns(columns).drop("scores"), models, metrics, tuple(levels))


def _resample_mixed(members, resamples: ResampleSet, metrics) -> ResampleResult:
    """Mixed models: the rows of all resamples become one group table, searched in common rounds.

    Recipes without learned steps are needed for that; others are fitted one resample at a time.
    """
    weights = {i: r.weight for i, r in resamples.resamples.items()}
    found, prepared = {}, {}
    with cached(resamples.df, _narrow_columns(members, resamples)) as rows:
        for n, w in members.items():
            if w.recipe.is_trained:
                own = w.recipe.prep_resamples(rows, weights)
                models = {i: fit_mixed_models(own[i], rows, dict(w.terms), {i: weights[i]})[i] for i in weights}
            else:
                own = dict.fromkeys(weights, w.recipe.prep(rows))
                models = fit_mixed_models(own[next(iter(weights))], rows, dict(w.terms), weights)
            found |= {(n, i): m for i, m in models.items()}
            prepared |= {(n, i): own[i] for i in weights}
    frame = _narrow_frame(members, resamples).withColumn("__id", F.explode(resamples.assessed_in()))
    scored = []
    for n, w in members.items():
        # one join on (resample, group) serves all resamples
        models = {i: found[n, i] for i in weights}
        effects = reduce(
            lambda a, b: a.unionByName(b), [m.effects.withColumn("__own", F.lit(i)) for i, m in models.items()]
        ).select("__own", F.col("g").alias("__g"), F.col("intercept").alias("__b0"), F.col("slope").alias("__b1"))
        terms = dict(w.terms)
        joined = frame.join(effects, (F.col("__id") == F.col("__own")) & (F.col(terms["group"]) == F.col("__g")), "left")
        pred = F.coalesce(*[F.when(F.col("__id") == i, prepared[n, i].score(m.fit.fixed)) for i, m in models.items()])
        pred = pred + F.coalesce("__b0", F.lit(0.0))
        if "slope" in terms:
            pred = pred + F.coalesce("__b1", F.lit(0.0)) * F.col(terms["slope"]).cast("double")
        scored.append(
            joined.select(
                F.lit(n).alias("wflow_id"), F.col("__id").alias("id"), F.col(resamples.key).alias("row"),
                F.col(w.recipe.outcome).cast("double").alias("truth"), pred.alias("pred"),
            )
        )
    fits = {key: model.fit for key, model in found.items()}
    return ResampleResult(reduce(lambda a, b: a.unionByName(b), scored), fits, metrics)


def _truth(workflow: Workflow) -> Column:
    """The outcome as a number; a censored time is no truth."""
    outcome = F.col(workflow.recipe.outcome).cast("double")
    event = dict(workflow.terms).get("event")
    return outcome if event is None else F.when(F.col(event).cast("double") > 0, outcome)


def _resample_others(members, resamples: ResampleSet, metrics) -> ResampleResult:
    """Iterative learners: one fit per resample over a cached narrow frame.

    Recipes are estimated for all resamples together. The predictors of trees are computed
    once for all fits and for scoring. Where a frame has fewer partitions than there are cores, a few
    fits run at a time, so the small stages of one overlap with the work of another.
    """
    weights = {i: r.weight for i, r in resamples.resamples.items()}
    pairs = [(n, i) for n in members for i in resamples.ids]
    trees = {n for n, w in members.items() if w.model.engine in TREE_ENGINES}
    with cached(resamples.df, _narrow_columns(members, resamples)) as rows:
        prepared = {n: w.recipe.prep_resamples(rows, weights) for n, w in members.items()}
        levels, sides = {}, {n: replace(resamples, df=rows) for n in members}
        for n in trees:
            levels[n] = tree_levels(prepared[n], rows, weights)
            columns, prepared[n] = tree_features(prepared[n], levels[n])
            sides[n] = replace(resamples, df=_kept_features(members[n], resamples, rows, columns))

        def fit_one(pair: tuple[str, str]) -> FittedWorkflow:
            n, i = pair
            spec, own, side = members[n].model, prepared[n][i], sides[n].analysis(i)
            if n in trees:
                return FittedWorkflow(members[n], own, fit_tree(spec, own, side, levels[n][i]))
            return FittedWorkflow(members[n], own, fit_model(spec, own, side, dict(members[n].terms)))

        def fit_all(some: list[tuple[str, str]]) -> dict[tuple[str, str], FittedWorkflow]:
            if not some:
                return {}
            cores = rows.sparkSession.sparkContext.defaultParallelism
            partitions = min(sides[n].df.rdd.getNumPartitions() for n, _ in some)
            with ThreadPool(max(1, min(_FITS_AT_ONCE, len(some), -(-cores // max(1, partitions))))) as pool:
                return dict(zip(some, pool.map(fit_one, some)))

        fitted = fit_all([p for p in pairs if p[0] not in trees])
    # the kept predictors are enough for the trees
    fitted |= fit_all([p for p in pairs if p[0] in trees])
    frames = [
        fitted[n, i].predict((sides[n] if n in trees else resamples).assessment(i)).select(
            F.lit(n).alias("wflow_id"),
            F.lit(i).alias("id"),
            F.col(resamples.key).alias("row"),
            _truth(members[n]).alias("truth"),
            "pred",
        )
        for n, i in pairs
    ]
    predictions = reduce(lambda a, b: a.unionByName(b), frames)
    # trees have no table of coefficients
    fits = {key: fitted[key].model.fit for key in pairs if hasattr(fitted[key].model, "fit")}
    return ResampleResult(predictions, fits, metrics)


def _kept_features(workflow: Workflow, resamples: ResampleSet, rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Key, outcome, marks of the resamples and predictors, computed and kept until the query ends."""
    marks = [c for c in rows.columns if c.startswith("__")]
    plain = list(dict.fromkeys([resamples.key, workflow.recipe.outcome, *marks]))
    kept = hold(rows.select(*plain, *[c.alias(n) for n, c in columns.items()]), dealt=True)
    kept.count()
    return kept


def rank_workflows(metrics: DataFrame, metric: str, higher_is_better: bool) -> DataFrame:
    """Summarised metrics of one kind, best first, with a mean +- 1.96 s.e. band."""
    kept = metrics.where(F.col("metric") == metric)
    order = F.col("mean").desc() if higher_is_better else F.col("mean").asc()
    # one row per workflow
    ranked = kept.withColumn("rank", F.rank().over(Window.partitionBy("metric").orderBy(order)))
    half = F.lit(1.96) * F.col("std_err")
    return ranked.select(
        "wflow_id", "metric", "mean", "std_err", "rank",
        (F.col("mean") - half).alias("lower"), (F.col("mean") + half).alias("upper"),
    )
