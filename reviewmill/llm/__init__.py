"""Operators of a training-data pipeline over documents, vectors and pages. Nothing else in the library imports this.

Functions of this subpackage travel to the executors inside the jobs, so these need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
