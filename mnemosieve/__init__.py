"""Spark-first hybrid retrieval, index maintenance and corpus operators."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value, so a cluster needs no copy of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
