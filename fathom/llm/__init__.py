"""Operators of a training-data pipeline; nothing else in the library imports this subpackage.

Its functions go to the executors by value, so that tasks run where the
library itself is not installed (third-party packages must be).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
