"""Operators that prepare text corpora for training. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so Python workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
