"""Operators for preparing training data at scale, and their queries.

Functions that Spark ships to its Python workers travel by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
