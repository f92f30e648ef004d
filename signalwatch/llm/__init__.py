"""Operators for preparing training text at scale; nothing else in the library needs them."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to executors by value, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
