"""Ashlar: a PySpark-native document-graph and corpus analytics engine."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code with them, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
