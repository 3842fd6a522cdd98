"""Operators that prepare text corpora for training."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers whole, so that a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
