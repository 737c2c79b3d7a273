"""lectern: hybrid text retrieval, catalog analytics and corpus preparation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the plan, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
