"""Operators for preparing training text, their queries and the SQL twins of these.

Functions of this subpackage that run in Python workers travel with the job, by value, so
executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
