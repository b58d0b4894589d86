"""Operators for large training corpora: deduplication, filtering, mixing, tokens."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job that calls them, so
# the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
