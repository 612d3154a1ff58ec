"""Document retrieval, answering and evaluation as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to executors carry this package's code with them, so that a
# cluster needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
