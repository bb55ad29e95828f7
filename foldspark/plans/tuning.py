"""Tunable arguments, parameter tables, grids and grid scoring."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldspark.operators.metrics import REGRESSION, summarize_metrics
from foldspark.operators.recipe import Recipe
from foldspark.operators.resample import ResampleSet
from foldspark.plans.workflow import ResampleResult, Workflow, fit_resamples


@dataclass(frozen=True)
class Tune:
    """A marker for an argument whose value a grid will supply."""

    id: str = ""


def tune(id: str = "") -> Tune:
    return Tune(id)


# Default ranges of tunable arguments; an upper bound of None depends on the data.
_RANGES = {
    "threshold": (0.0, 0.1),
    "deg_free": (1, 15),
    "penalty": (1e-10, 1.0),
    "mixture": (0.0, 1.0),
    "mtry": (1, None),
    "min_n": (2, 40),
    "trees": (1, 2000),
}


@dataclass(frozen=True)
class Parameter:
    id: str
    name: str
    source: str  # recipe or model
    low: float | None
    high: float | None


@dataclass(frozen=True)
class ParameterSet:
    """The tunable arguments of a recipe, a model or a workflow."""

    parameters: tuple[Parameter, ...]

    def get(self, id: str) -> Parameter:
        for p in self.parameters:
            if p.id == id:
                return p
        raise ValueError(f"no tunable parameter {id}")

    def update(self, **ranges: tuple[float, float]) -> "ParameterSet":
        for id in ranges:
            self.get(id)
        changed = [
            replace(p, low=ranges[p.id][0], high=ranges[p.id][1]) if p.id in ranges else p
            for p in self.parameters
        ]
        return ParameterSet(tuple(changed))

    def finalize(self, df: DataFrame, outcome: str) -> "ParameterSet":
        """Fill bounds that depend on the data: mtry is at most the predictor count."""
        predictors = len([c for c in df.columns if c != outcome])
        changed = [
            replace(p, high=predictors) if p.name == "mtry" and p.high is None else p
            for p in self.parameters
        ]
        return ParameterSet(tuple(changed))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (p.id, p.name, p.source, _number(p.low), _number(p.high)) for p in self.parameters
        ]
        return spark.createDataFrame(
            rows, "id string, name string, source string, low double, high double"
        )

    def regular_grid(self, spark: SparkSession, levels: int) -> DataFrame:
        values = {}
        for p in self.parameters:
            if p.high is None:
                raise ValueError(f"the upper bound of {p.id} depends on the data: finalize first")
            span = [p.low + (p.high - p.low) * i / max(levels - 1, 1) for i in range(levels)]
            whole = isinstance(p.low, int) and isinstance(p.high, int)
            values[p.id] = sorted({round(v) for v in span}) if whole else span
        return grid(spark, values)


def _number(value) -> float | None:
    return None if value is None else float(value)


def grid(spark: SparkSession, values: dict[str, list]) -> DataFrame:
    """One row per combination of the listed values."""
    table = spark.range(1).select()
    for name, options in values.items():
        table = table.select("*", F.explode(F.array(*[F.lit(v) for v in options])).alias(name))
    return table


def _marked(source) -> list[tuple[object, str, Tune]]:
    if isinstance(source, Recipe):
        return [
            (step, f.name, getattr(step, f.name))
            for step in source.steps
            for f in fields(step)
            if isinstance(getattr(step, f.name), Tune)
        ]
    return [(source, name, value) for name, value in source.arguments if isinstance(value, Tune)]


def tunable(workflow: Workflow) -> ParameterSet:
    """The parameter table of a workflow."""
    found = []
    for label, source in (("recipe", workflow.recipe), ("model", workflow.model)):
        for _, name, mark in _marked(source) if source is not None else []:
            low, high = _RANGES.get(name, (None, None))
            found.append(Parameter(mark.id or name, name, label, low, high))
    return ParameterSet(tuple(found))


def finalize_workflow(workflow: Workflow, values: dict[str, object]) -> Workflow:
    """Replace the markers with values."""
    recipe, model = workflow.recipe, workflow.model
    if recipe is not None:
        steps = []
        for step in recipe.steps:
            changes = {
                f.name: values[getattr(step, f.name).id or f.name]
                for f in fields(step)
                if isinstance(getattr(step, f.name), Tune)
            }
            steps.append(replace(step, **changes) if changes else step)
        # an unchanged recipe stays the same object, so that its candidates share its estimation
        if any(a is not b for a, b in zip(steps, recipe.steps)):
            recipe = replace(recipe, steps=tuple(steps))
    if model is not None:
        changes = {n: values[m.id or n] for _, n, m in _marked(model)}
        model = model.with_arguments(**changes) if changes else model
    return replace(workflow, recipe=recipe, model=model)


@dataclass(frozen=True)
class TuneResult:
    candidates: dict[str, dict]
    resampled: ResampleResult

    def collect_metrics(self) -> DataFrame:
        """Summarised metrics with the grid values next to them."""
        spark = self.resampled.predictions.sparkSession
        names = list(next(iter(self.candidates.values())))
        rows = [(wflow, *[float(c[n]) for n in names]) for wflow, c in self.candidates.items()]
        table = spark.createDataFrame(rows, ["wflow_id", *names])
        summary = summarize_metrics(self.resampled.collect_metrics(summarize=False), ["wflow_id"])
        return summary.join(F.broadcast(table), "wflow_id")  # one row per candidate

    def best(self, metric: str, higher_is_better: bool = False) -> DataFrame:
        kept = self.collect_metrics().where(F.col("metric") == metric)
        order = F.col("mean").desc() if higher_is_better else F.col("mean").asc()
        return kept.orderBy(order, "wflow_id").limit(1)


#: Most candidates of a grid: each is a model whose numbers the driver holds.
MAX_CANDIDATES = 10_000


def tune_grid(
    workflow: Workflow, table: DataFrame, resamples: ResampleSet, metrics: tuple[str, ...] | None = None
) -> TuneResult:
    """Score every grid row on the shared resamples, as one workflow set."""
    rows = [row.asDict() for row in table.limit(MAX_CANDIDATES + 1).collect()]
    if len(rows) > MAX_CANDIDATES:
        raise ValueError(f"more than {MAX_CANDIDATES} candidates")
    width = max(2, len(str(len(rows))))
    candidates = {f"candidate_{i:0{width}d}": row for i, row in enumerate(rows, start=1)}
    members = {n: finalize_workflow(workflow, values) for n, values in candidates.items()}
    return TuneResult(candidates, fit_resamples(members, resamples, metrics))
