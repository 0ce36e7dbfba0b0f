"""Spark-first analytics for collected price quotations and the documents they come from."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions with the tasks, so a cluster needs no copy of it on its nodes
cloudpickle.register_pickle_by_value(sys.modules[__name__])
