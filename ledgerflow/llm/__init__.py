"""Operators for training-data pipelines.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries when it is present.  Functions that run in Python workers are shipped
by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
