"""Film-catalogue analytics as plain PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Python workers get the few UDFs by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
