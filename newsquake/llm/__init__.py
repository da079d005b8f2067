"""Operators for training-data pipelines; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors with the tasks that call them, installed there or not.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
