"""Operators of a training-data pipeline; nothing else in the library imports this package.

Their Python functions travel to the executors by value, so the executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
