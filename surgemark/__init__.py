"""Anomaly analytics over event streams, written as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

from surgemark.config import EngineConfig

# Functions that run inside Python workers travel by value, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["EngineConfig"]
