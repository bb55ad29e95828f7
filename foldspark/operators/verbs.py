"""Table verbs that are more than one Spark call."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from foldspark.functions.hashing import hash01
from foldspark.operators.ordered import positions


# ---------------------------------------------------------------- column selection

def keep_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c.startswith(prefix)])


def drop_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def columns_containing(df: DataFrame, text: str) -> list[str]:
    return [c for c in df.columns if text in c]


def nominal_columns(df: DataFrame, roles: dict[str, str] | None = None, role: str | None = None) -> list[str]:
    """Text columns, with a given role if one is asked for."""
    return [
        name
        for name, kind in df.dtypes
        if kind == "string" and (role is None or (roles or {}).get(name) == role)
    ]


def transform_columns(df: DataFrame, names: list[str], change: Callable[[Column], Column]) -> DataFrame:
    """Apply one function to several columns."""
    return df.withColumns({name: change(F.col(name)) for name in names})


def fill(df: DataFrame, **values) -> DataFrame:
    """Replace missing values per column."""
    return df.fillna(values)


# ---------------------------------------------------------------- missing values

def sum_missing(name: str) -> Column:
    """A sum that is missing when any value is."""
    return F.when(F.count(name) == F.count("*"), F.sum(name))


def mean_missing(name: str) -> Column:
    """A mean that is missing when any value is."""
    return F.when(F.count(name) == F.count("*"), F.avg(name))


# ---------------------------------------------------------------- joins

def member_flag(df: DataFrame, other: DataFrame, keys: dict[str, str], name: str) -> DataFrame:
    """True where the row's key occurs in ``other``: a left join on distinct keys."""
    found = other.select(*[F.col(b).alias(f"__{a}") for a, b in keys.items()]).distinct()
    marked = found.withColumn("__member", F.lit(True))
    condition = None
    for a in keys:
        same = F.col(a) == F.col(f"__{a}")
        condition = same if condition is None else condition & same
    joined = df.join(marked, condition, "left")
    return joined.withColumn(name, F.coalesce("__member", F.lit(False))).drop(
        "__member", *[f"__{a}" for a in keys]
    )


def top_rows(df: DataFrame, by: Column, k: int, key: str) -> DataFrame:
    """The k rows with the largest value, ties in key order: no full sort."""
    return df.orderBy(by.desc(), key).limit(k)


def lookup_rows(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` named by keys, such as a top-k result; Spark broadcasts them if they are few."""
    return df.join(wanted.select(key), key, "left_semi")


# ---------------------------------------------------------------- nesting

def group_nest(df: DataFrame, by: list[str], key: str, cells: int = 1) -> DataFrame:
    """Rows as an array of structs per group: (by, cell, data).

    Every group is dealt by row hash into ``cells`` cells (fewer if it has fewer
    rows), so that with enough of them no row of the result, and no task, holds a
    whole large group. The number is the caller's and the same for all groups.
    """
    data = [c for c in df.columns if c not in by]
    cell = F.floor(hash01("nest", key) * cells).cast("long")
    dealt = df.select(*by, cell.alias("cell"), F.struct(*data).alias("__row"))
    return dealt.groupBy(*by, "cell").agg(F.collect_list("__row").alias("data"))


def unnest(nested: DataFrame, column: str = "data") -> DataFrame:
    """One row per struct of the array column."""
    others = [c for c in nested.columns if c != column]
    return nested.select(*others, F.inline(column))


# ---------------------------------------------------------------- levels

def levels_table(df: DataFrame, column: str) -> DataFrame:
    """Sorted levels of a text column with their 1-based codes.

    Levels are numbered by their place in a range partition and the levels of earlier ones, so they may be many.
    """
    levels = df.where(F.col(column).isNotNull()).select(F.col(column).alias("level")).distinct()
    return positions(levels, "level", "code").withColumn("code", F.col("code").cast("int"))
