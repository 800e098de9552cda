"""Operators of a training-data pipeline over whole corpora."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its functions are sent to them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
