"""All registered queries."""

from foldspark.plans import (  # noqa: F401
    queries_features,
    queries_metrics,
    queries_models,
    queries_resample,
    queries_tables,
    queries_workflows,
)
from foldspark.plans.registry import ORACLES, QUERIES  # noqa: F401

FLAGSHIP = "m2_regression_per_group"
