"""Operators of a training-data pipeline, one module each, and their queries.

Executors need no installed copy of this package: the functions that run in
Python workers are pickled by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
