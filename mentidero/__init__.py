"""Social-text analytics on Spark: medallion tables, profiling, training sets, scoring."""

import sys

from pyspark import cloudpickle

# Functions of this package reach Python workers by value; executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
