"""Operators for training-data pipelines; nothing outside this subpackage imports it.

Functions of this package travel to the executors by value, so those need the
installed libraries only and not this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
