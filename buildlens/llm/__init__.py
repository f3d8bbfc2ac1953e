"""Operators for preparing language-model training text.

Functions of this package travel to the executors by value, so that a cluster needs no installation of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
