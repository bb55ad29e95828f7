"""What prediction does with rows whose predictors are missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def predict_rows(fitted, df: DataFrame, missing: str = "pass", kind: str = "numeric") -> DataFrame:
    """``pass`` gives a missing prediction, ``omit`` drops the row, ``fail`` raises."""
    predictors = fitted.workflow.recipe.raw_columns
    if missing == "pass":
        return fitted.predict(df, kind)
    if missing == "omit":
        return fitted.predict(df.dropna(subset=predictors), kind)
    if missing != "fail":
        raise ValueError("missing is pass, omit or fail")
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in predictors], F.lit(True))
    # checked row by row while the job runs: no extra pass over the table
    checked = F.assert_true(complete, F.lit("missing values in the predictors"))
    return fitted.predict(df.where(checked.isNull()), kind)
