"""Search and analytics over document tables with PySpark."""

import sys

from pyspark import cloudpickle

# Kernels are pickled whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
