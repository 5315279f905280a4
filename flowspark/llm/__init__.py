"""Operations for preparing training data: dedup, formatting, scoring, packing, archives."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to executors by value, so that a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
