"""Splits and resamples as deterministic functions of a unique row key.

A resample set never copies data. It names, for each resample, one Column for
the analysis weight of a row (0, 1 or a multiplicity) and one for whether the row
is assessed. Sizes are exact: the hash values that cut the table at the wanted
ranks are found with two small aggregations (:func:`hash_cuts`).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from foldspark.functions.hashing import hash_bits, hash_index
from foldspark.operators.ordered import exact_quantiles, hash_cuts, positions
from foldspark.session import cached, spread

_STRATA_BINS = 4
_SMALL_STRATUM = 0.1


@dataclass(frozen=True)
class Resample:
    """One analysis / assessment pair."""

    weight: Column  # analysis multiplicity, 0 when the row is not in the analysis set
    assess: Column  # boolean: the row is in the assessment set


@dataclass(frozen=True)
class ResampleSet:
    """Resamples over one table. ``fold`` is set when assessment sets partition it."""

    df: DataFrame
    key: str
    resamples: dict[str, Resample]
    fold: Column | None = field(default=None)
    assessed: Column | None = field(default=None)  # ids as an array, if cheaper than asking each

    def assessed_in(self) -> Column:
        """The ids of the resamples that assess a row."""
        if self.assessed is not None:
            return self.assessed
        return F.filter(
            F.array(*[F.when(r.assess, F.lit(n)) for n, r in self.resamples.items()]),
            lambda v: v.isNotNull(),
        )

    @property
    def ids(self) -> list[str]:
        return list(self.resamples)

    def analysis(self, resample_id: str) -> DataFrame:
        """Rows of one analysis set, repeated by multiplicity."""
        weight = self.resamples[resample_id].weight
        repeats = F.explode(F.sequence(F.lit(1), F.col("__w")))
        kept = self.df.withColumn("__w", weight.cast("int")).where("__w > 0")
        return kept.withColumn("__i", repeats).drop("__w", "__i")

    def assessment(self, resample_id: str) -> DataFrame:
        return self.df.where(self.resamples[resample_id].assess)

    def assessment_membership(self) -> DataFrame:
        """The assessment side of the membership table alone."""
        sides = self.df.select(F.col(self.key).alias("row"), F.explode(self.assessed_in()).alias("id"))
        return sides.select(
            "row", "id", F.lit("assessment").alias("role"), F.lit(1).cast("long").alias("times")
        )

    def membership(self) -> DataFrame:
        """Long table (row, id, role, times), from one narrow pass over the rows."""
        entries = []
        for name, sample in self.resamples.items():
            weight = sample.weight.cast("long")
            entries.append(_entry(name, "analysis", weight))
            entries.append(_entry(name, "assessment", sample.assess.cast("long")))
        return (
            self.df.select(
                F.col(self.key).alias("row"),
                F.explode(F.filter(F.array(*entries), lambda e: e["times"] > 0)).alias("m"),
            ).select("row", "m.id", "m.role", "m.times")
        )

    def sizes(self) -> DataFrame:
        """Rows on each side of each resample."""
        return self.membership().groupBy("id", "role").agg(F.sum("times").alias("n"))


def _entry(name: str, role: str, times: Column) -> Column:
    return F.struct(F.lit(name).alias("id"), F.lit(role).alias("role"), times.alias("times"))


# ---------------------------------------------------------------- strata

def quantile_bin(value: Column, breaks: list[float]) -> Column:
    """The quantile bin of a value as text, ``1`` being the lowest."""
    over = [F.when(value > b, 1).otherwise(0) for b in breaks]
    bin_number = reduce(lambda a, b: a + b, over, F.lit(1))
    return F.when(value.isNotNull(), bin_number.cast("string"))


def strata_column(df: DataFrame, strata: str | None, bins: int = _STRATA_BINS) -> Column | None:
    """Quantile bins of a number; the levels of a text with small ones pooled.

    A level with less than a tenth of the rows joins one pooled stratum, so there
    are never more than eleven strata.
    """
    if strata is None:
        return None
    if dict(df.dtypes)[strata] == "string":
        total = df.count()
        big = (
            df.groupBy(strata)
            .count()
            .where(F.col("count") >= _SMALL_STRATUM * total)
            .select(strata)
            .collect()
        )
        names = [row[0] for row in big if row[0] is not None]
        return F.when(F.col(strata).isin(names), F.col(strata)).otherwise(F.lit("(pooled)"))
    grid = [i / bins for i in range(1, bins)]
    breaks = exact_quantiles(df, strata, grid)["all"]
    return F.coalesce(quantile_bin(F.col(strata), breaks), F.lit("(missing)"))


def _cut_literal(cuts: dict[str, list[int]], stratum: Column | None, slot: int) -> Column:
    """The literal cut of a row's stratum."""
    if stratum is None:
        only = cuts.get("all")
        return F.lit(only[slot] if only else -1)
    chain = F.lit(-1).cast("long")
    for level, values in cuts.items():
        chain = F.when(stratum == F.lit(level), F.lit(values[slot])).otherwise(chain)
    return chain


# ---------------------------------------------------------------- splits

@dataclass(frozen=True)
class Split:
    """A train / test split: ``in_train`` is a comparison with literals."""

    df: DataFrame
    key: str
    in_train: Column

    def labelled(self) -> DataFrame:
        role = F.when(self.in_train, F.lit("training")).otherwise(F.lit("testing"))
        return self.df.withColumn("role", role)


def _part(prop: float):
    """The number of rows in a share of n, rounded down."""
    return lambda n: [F.floor(n * prop)]


def initial_split(
    df: DataFrame,
    key: str,
    prop: float = 0.75,
    strata: str | None = None,
    seed: int = 0,
) -> Split:
    """floor(n * prop) training rows in every stratum."""
    bits = hash_bits(seed, key)
    with cached(df, [key, *([strata] if strata else [])]) as narrow:
        stratum = strata_column(narrow, strata)
        cuts = hash_cuts(narrow, {"train": bits}, _part(prop), stratum)["train"]
    return Split(df, key, bits <= _cut_literal(cuts, stratum, 0))


def training(split: Split) -> DataFrame:
    return split.df.where(split.in_train)


def testing(split: Split) -> DataFrame:
    return split.df.where(~split.in_train)


# ---------------------------------------------------------------- resample sets

def _fold_ranks(v: int):
    """Last rank of every fold but the final one; the first n mod v folds are longer."""
    return lambda n: [F.lit(i) * F.floor(n / v) + F.least(F.lit(i), n % v) for i in range(1, v)]


def _numbered(prefix: str, n: int) -> list[str]:
    width = max(2, len(str(n)))
    return [f"{prefix}{i:0{width}d}" for i in range(1, n + 1)]


def _fold_number(bits: Column, cuts: dict[str, list[int]], v: int) -> Column:
    over = [F.when(bits > _cut_literal(cuts, None, i), 1).otherwise(0) for i in range(v - 1)]
    return reduce(lambda a, b: a + b, over, F.lit(1))


def vfold_cv(
    df: DataFrame, key: str, v: int = 10, repeats: int = 1, seed: int = 0
) -> ResampleSet:
    """v folds of equal size, drawn again for every repeat.

    Fold numbers are attached as columns, so a row's hash is computed once.
    """
    runs = {f"Repeat{r}": hash_bits(seed if r == 1 else f"{seed}.{r}", key) for r in range(1, repeats + 1)}
    with cached(df, [key]) as narrow:
        cuts = hash_cuts(narrow, runs, _fold_ranks(v))
    resamples: dict[str, Resample] = {}
    columns = {}
    for run, bits in runs.items():
        name = f"__fold_{run}"
        columns[name] = _fold_number(bits, cuts[run], v)
        for number, fold_id in enumerate(_numbered("Fold", v), start=1):
            label = fold_id if repeats == 1 else f"{run}_{fold_id}"
            inside = F.col(name) == number
            resamples[label] = Resample(F.when(inside, 0).otherwise(1), inside)
    fold = F.col("__fold_Repeat1") if repeats == 1 else None
    width = len(_numbered("", v)[0])
    labels = [
        F.concat(
            F.lit("Fold" if repeats == 1 else f"{run}_Fold"),
            F.lpad(F.col(f"__fold_{run}").cast("string"), width, "0"),
        )
        for run in runs
    ]
    return ResampleSet(spread(df).withColumns(columns), key, resamples, fold, F.array(*labels))


def mc_cv(
    df: DataFrame, key: str, prop: float = 0.75, times: int = 25, seed: int = 0
) -> ResampleSet:
    """Independent random splits."""
    names = _numbered("Resample", times)
    bits = {name: hash_bits(f"{seed}.{i}", key) for i, name in enumerate(names, start=1)}
    with cached(df, [key]) as narrow:
        cuts = hash_cuts(narrow, bits, _part(prop))
    columns = {f"__in_{n}": bits[n] <= _cut_literal(cuts[n], None, 0) for n in names}
    resamples = {
        n: Resample(F.col(f"__in_{n}").cast("int"), ~F.col(f"__in_{n}")) for n in names
    }
    return ResampleSet(spread(df).withColumns(columns), key, resamples)


def validation_split(df: DataFrame, key: str, prop: float = 0.75, seed: int = 0) -> ResampleSet:
    """One random split used as a single resample."""
    split = initial_split(df, key, prop, seed=seed)
    marked = df.withColumn("__in_validation", split.in_train)
    inside = F.col("__in_validation")
    return ResampleSet(marked, key, {"validation": Resample(inside.cast("int"), ~inside)})


def bootstraps(df: DataFrame, key: str, times: int = 25, seed: int = 0) -> ResampleSet:
    """Draws of n rows with replacement; rows never drawn are assessed.

    Each draw names a position; draws are counted per position before they meet
    the rows, so the join key is unique on both sides and cannot be skewed.
    """
    names = _numbered("Bootstrap", times)
    n = df.count()
    drawn = (
        df.sparkSession.range(n)
        .select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(i).alias("r"), hash_index(n, f"{seed}.{i}", "id").alias("p"))
                        for i in range(1, times + 1)
                    ]
                )
            ).alias("d")
        )
        .select((F.col("d.p") + 1).alias("__position"), F.col("d.r").alias("r"))
    )
    counts = drawn.groupBy("__position").agg(
        *[
            F.sum((F.col("r") == i).cast("int")).cast("int").alias(f"__times_{name}")
            for i, name in enumerate(names, start=1)
        ]
    )
    placed = positions(df.select(key), key, "__position").join(counts, "__position", "left")
    placed = placed.drop("__position").fillna(0, subset=[f"__times_{n}" for n in names])
    resamples = {
        n: Resample(F.col(f"__times_{n}"), F.col(f"__times_{n}") == 0) for n in names
    }
    return ResampleSet(df.join(placed, key), key, resamples)


# ---------------------------------------------------------------- rolling origin

def rolling_origin(
    df: DataFrame, position: str, initial: int, assess: int, skip: int = 0
) -> DataFrame:
    """Sliding analysis / assessment windows over 1-based positions.

    Slice k starts at 1 + k (skip + 1) and a slice is kept while its assessment
    window fits. The slices that contain a position are an interval of k, so each
    row lists its own slices: there is no join. Adds ``slice`` and ``role``.
    """
    step = skip + 1
    n = df.agg(F.max(position)).first()[0] or 0
    last = (n - initial - assess) // step  # number of the last slice
    x = F.col(position)

    def slices(first_offset: int, length: int) -> Column:
        # 0 <= x - 1 - first_offset - k step < length
        high = F.floor((x - 1 - first_offset) / step)
        low = F.floor((x - 1 - first_offset - length) / step) + 1
        low, high = F.greatest(low, F.lit(0)), F.least(high, F.lit(last))
        return F.when(low <= high, F.sequence(low, high)).otherwise(
            F.array().cast("array<bigint>")
        )

    both = F.concat(
        F.transform(slices(0, initial), lambda k: _slice(k, "analysis")),
        F.transform(slices(initial, assess), lambda k: _slice(k, "assessment")),
    )
    return df.withColumn("__m", F.explode(both)).select(
        *df.columns, (F.col("__m.k") + 1).alias("slice"), F.col("__m.role").alias("role")
    )


def _slice(k: Column, role: str) -> Column:
    return F.struct(k.alias("k"), F.lit(role).alias("role"))
