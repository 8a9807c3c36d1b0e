"""Correction-aware, point-in-time event analytics expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
