"""Operators of a training-data pipeline: one module for each method.

Nothing else in the library imports this package. ``queries`` and ``sql`` hold
the registered queries over the given tables and their SQL twins.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
