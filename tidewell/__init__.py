"""tidewell: behaviour analytics and batch recommendation as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions run inside tasks travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
