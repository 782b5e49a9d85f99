"""Operators on text for training data, and their queries.

Functions of this package travel to executors by value, so it need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
