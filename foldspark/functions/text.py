"""Text helpers for codes, labels and column names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def last_chars(value: Column, n: int) -> Column:
    return F.substring(value, -n, n)


def first_chars(value: Column, n: int) -> Column:
    return F.substring(value, 1, n)


def remove_first(text: str, pattern: str) -> str:
    """Drop the first match of a pattern from a name."""
    return re.sub(pattern, "", text, count=1)


def remove_all(value: Column, pattern: str) -> Column:
    return F.regexp_replace(value, pattern, "")


def paste(*values: Column, sep: str = " ") -> Column:
    """Join values to one text; a missing value becomes the text ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(v.cast("string"), F.lit("NA")) for v in values])


def rename_all(df: DataFrame, rename) -> DataFrame:
    """Rename every column with a function of its name."""
    return df.withColumnsRenamed({name: rename(name) for name in df.columns})


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return rename_all(df, lambda name: remove_first(name, re.escape(prefix)))
