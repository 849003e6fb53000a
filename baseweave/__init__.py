"""baseweave: genome-wide site classification and interval algebra on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python workers need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
