"""Array constants sent to Spark as one value each."""

from __future__ import annotations

import json

from pyspark.sql import Column, functions as F


def array_constant(value, ddl: str = "array<double>") -> Column:
    """A nested array as one text literal, folded to a constant by the optimizer.

    A thousand coefficients would otherwise be a thousand expression nodes.
    """
    return F.from_json(F.lit(json.dumps(value)), ddl)


def text_constant(values) -> Column:
    return array_constant(list(values), "array<string>")
