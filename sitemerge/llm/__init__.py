"""Operators for preparing training data at scale.

Nothing else in the library imports this subpackage.  Its functions are
shipped to Python workers by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
