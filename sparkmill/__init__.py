"""Spark-native operators for producing, checking and measuring nested-record datasets."""

import sys

from pyspark import cloudpickle

# What runs in Python on executors travels by value, so that they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
