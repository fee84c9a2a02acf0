"""Chat-message sentiment analytics on Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Code of this package travels inside the plans that use it, so that Python workers run it
# without having the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
