"""Operators of a training-data pipeline. Nothing else in the library imports them.

Their functions travel to the executors by value, so that a cluster needs no
copy of this package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
