"""Operators for training data: deduplication, filters, classifiers, sharding, mixing, formats, tokens.

What tasks run in Python travels to the executors by value, so the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
