"""rovermill: a PySpark batch and streaming engine for mobile-robot ride telemetry."""

import sys

from pyspark import cloudpickle

# Python workers on executors need not have this package: functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
