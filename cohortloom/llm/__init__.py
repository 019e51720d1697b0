"""Operators for preparing training data, and their queries.

Functions of this package travel to the executors by value, which therefore
need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
