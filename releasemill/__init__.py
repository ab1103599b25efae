"""Spark jobs that turn device-registry release archives into tables."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Task functions travel inside the job itself, so executors need no copy of
# this package on their path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
