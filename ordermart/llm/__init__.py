"""Operators for large training-data pipelines.

Every operator is a function on DataFrames.  Functions that run inside tasks travel to the
executors by value, so a job needs no copy of this package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
