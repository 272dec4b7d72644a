"""Health time series on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job: workers need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
