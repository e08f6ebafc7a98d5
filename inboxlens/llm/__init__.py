"""Operators for preparing training corpora, one module each.

The functions that run in Python workers are pickled by value, so a job needs no copy
of this package on its executors.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
