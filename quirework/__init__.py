"""Quirework: page text to checked knowledge base, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# functions of this package travel to executors by value, so that a cluster needs no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
