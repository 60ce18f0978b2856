"""Operators for building language-model training data.

Each module holds one operator on DataFrames; ``queries`` binds them to the
given tables.  Functions of this package travel to the executors by value, so
the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
