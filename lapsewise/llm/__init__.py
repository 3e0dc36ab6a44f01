"""Operators of a training-data pipeline: one module each, queries in ``catalog``."""

import sys

from pyspark import cloudpickle

# Executors need no installed copy of this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
