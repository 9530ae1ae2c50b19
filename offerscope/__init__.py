"""Job-advertisement text analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel with the task, so
# workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
