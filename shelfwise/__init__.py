"""shelfwise: product-catalogue analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The batch functions of this package travel with the job, so executors need
# no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
