"""foldspark: tabular modelling on Spark DataFrames.

Build an analysis table, split and resample it, estimate a recipe, fit and
score models, compute metrics and compare workflows. Every data-sized step is a
DataFrame expression or a distributed aggregate; only small parameter tables
(coefficients, knots, level lists) ever reach the driver.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Kernels are shipped with the job, so executors need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
