"""Operators for preparing language-model training data.

Nothing else in the package imports this subpackage. Its task functions are
sent to executors by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
