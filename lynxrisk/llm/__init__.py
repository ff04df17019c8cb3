"""Operators for preparing training data: deduplication, filtering, mixing, formatting, packing."""

import sys

from pyspark import cloudpickle

# functions of this package travel with the tasks that call them, so workers need not have it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
