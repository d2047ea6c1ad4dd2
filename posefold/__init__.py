"""Telemetry geometry audit and repair as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions that run in tasks travel with them, so executors need no copy of this
# package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
