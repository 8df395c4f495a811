"""A PySpark-native engine for disclosure and document pipelines."""

import sys

from pyspark import cloudpickle

# Functions of this package go to the executors by value: they need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
