"""Operators of a training-data pipeline. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value: no package has to be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
