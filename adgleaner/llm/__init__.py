"""Operators for preparing training data. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Executors get the helpers of this package with each task, and need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
