"""Operators for training data: deduplication, quality, secrets, extraction, mixing, tokens.

Each module holds one operator with its own general interface; ``queries`` applies
them to the given tables. Functions that run inside tasks are shipped by value, so
executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
