"""Operators of a training-data pipeline: texts, tokens, vectors.

Nothing else in the library imports this subpackage. Operators take and return
DataFrames; text work runs in Arrow batches inside Spark's tasks. The functions that
tasks run are sent along with them, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
