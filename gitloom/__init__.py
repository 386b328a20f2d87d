"""Commit intelligence as composable PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Tasks receive the library's functions by value: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
