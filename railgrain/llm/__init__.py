"""Operators for preparing language-model training data; nothing else in the library imports this package.

Functions of this package that run in Python workers travel by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
