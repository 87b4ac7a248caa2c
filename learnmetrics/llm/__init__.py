"""Operators of a training-data pipeline: language and quality filters, deduplication,
tokenisation, packing and vector search over document tables.

Nothing else in the library imports this subpackage. Its functions travel to the Python
workers by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
