"""Offline recommendation analytics as PySpark jobs."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: functions that run inside tasks travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
