"""Operators for training-data pipelines over a table of documents (doc_id, text).

Functions of this subpackage that run in tasks are shipped by value, so executors need no copy
of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
