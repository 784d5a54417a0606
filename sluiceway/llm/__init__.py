"""Operators of a training-data pipeline: quality, near-duplicates, leaks, shards, archives, packing, scoring.

Functions of this package that run in Python tasks are shipped to the executors by value, so a cluster
needs the package on its driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
