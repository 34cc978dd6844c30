"""Operators of a training-data pipeline over a table of documents.

Functions of this package travel to the workers by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
