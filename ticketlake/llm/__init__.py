"""Operators for preparing large text corpora.

Their functions travel to the executors with the tasks, so the package need
not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
