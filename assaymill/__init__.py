"""Spark-first engine for auditing, reconciling and releasing scientific tables."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers need no copy of the package: its functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
