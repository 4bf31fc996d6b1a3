"""Operators for preparing training data: every module is one operator with its own method.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel by value, wherever the driver was started.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
