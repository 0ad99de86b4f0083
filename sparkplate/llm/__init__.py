"""Operators for training-data preparation; nothing else in the library imports this package.

Task functions are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
