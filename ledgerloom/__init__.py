"""Financial-text corpus preparation and profiling as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with them: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
