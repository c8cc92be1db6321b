"""quire: a PySpark-native engine for corpora of structured documents."""

import sys

from pyspark import cloudpickle

# Python functions go to the executors by value, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
