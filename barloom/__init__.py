"""Market-candle analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with the job: workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
