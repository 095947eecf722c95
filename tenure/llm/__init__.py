"""Operators for building training corpora from text: ten of them, one module each.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are shipped by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
