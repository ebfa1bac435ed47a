"""Operators of a training-data pipeline; nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value, so that workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
