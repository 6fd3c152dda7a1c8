"""Operators of a training-data pipeline, each on DataFrames of documents, pages or benchmark items.

Functions that run in Python workers are sent by value, so that executors need
this package neither installed nor on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
