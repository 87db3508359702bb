"""Operators on training data.

Functions that run inside tasks travel with the task instead of being imported there, so that executors need Python, NumPy
and Arrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
