"""Operators for training-data pipelines; nothing else in the library imports this package.

Functions of this package travel to the Python workers by value, so that they run on
executors whose path does not hold the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
