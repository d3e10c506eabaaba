"""Trade ticks to OHLCV candles on PySpark, in batch and as a stream."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors inside the job, so a cluster needs no copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
