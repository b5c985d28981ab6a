"""Operators of a training-data pipeline, one module each; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value. What they use by the name of a module must be found there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
