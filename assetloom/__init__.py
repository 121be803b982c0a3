"""assetloom: data-asset operators for Apache Spark.

Every operator takes and returns DataFrames; the work runs on the executors.
"""

import sys

from pyspark import cloudpickle

# Functions shipped to Python workers travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
