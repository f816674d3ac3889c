"""Operators for preparing training text at scale; nothing else in the library imports this package.

Tasks carry the functions of this package by value, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
