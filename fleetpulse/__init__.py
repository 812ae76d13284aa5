"""Connected-vehicle telemetry analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers with their code: executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
