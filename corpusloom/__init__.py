"""Spark-native engine for building instruction-tuning datasets from documents."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers receive the package's functions by value: executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
