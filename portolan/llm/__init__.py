"""Operators for large-scale training data. Nothing else in the library imports this package.

Functions of this package that run in tasks are sent by value, so executors need not have the
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
