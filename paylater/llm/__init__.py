"""Training-data operators: duplicates, search, quality filters, encoding, packing."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this subpackage go to the executors with their code, so that it
# need not be installed there.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
