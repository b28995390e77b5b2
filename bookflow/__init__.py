"""bookflow: bookkeeping-file intake, header mapping and curated ledgers on Spark."""

import sys

from pyspark import cloudpickle

from bookflow.options import Options

# The few Python functions travel to the executors by value, so no copy of the package is needed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Options"]
