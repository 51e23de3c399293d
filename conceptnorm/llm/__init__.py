"""Operators for preparing training data. Nothing else in the package imports this subpackage.

Functions that run on executors are shipped by value, so a cluster need not have this package
installed on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
