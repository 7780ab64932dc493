"""Operators for building language-model training data.

Nothing outside this package imports it. Functions that run in Python workers
are pickled by value, so that executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
