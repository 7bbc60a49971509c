"""Operators for corpora of training text. Nothing else in the library depends on this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: no installation is needed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
