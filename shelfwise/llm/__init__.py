"""Operators for training-data pipelines over documents, vectors and conversations.

Nothing else in the library imports this subpackage. Its functions travel to
the Python workers by value, so that workers need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
