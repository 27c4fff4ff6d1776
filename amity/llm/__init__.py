"""Operators of a training-data pipeline; nothing else in the package uses them.

Tasks carry the functions they run, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
