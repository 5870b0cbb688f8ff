"""Operators for preparing language-model training text, on Spark.

Nothing outside this package imports it.  Functions that run in Python workers
are shipped by value, so the workers need not be able to import ``strata``.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
