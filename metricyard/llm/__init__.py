"""Training-data operators. Their task functions travel to the executors by value, so a cluster's Python
workers do not need this package on their path."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
