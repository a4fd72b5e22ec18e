"""Operators of a large training-data pipeline, as Spark jobs.

Nothing outside this subpackage imports it.  Functions that run in Python
tasks travel with the task by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
