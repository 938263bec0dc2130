"""Spark-native engine for time-series quality, index levels and reconciliation."""

import sys

from pyspark import cloudpickle

# Functions shipped to executors travel by value, so that a cluster needs no install of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
