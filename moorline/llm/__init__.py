"""Operators for training-data pipelines, each with its query and its SQL where SQL can say it.

Functions of this package travel to the executors by value, so a cluster needs numpy and
pyarrow there but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
