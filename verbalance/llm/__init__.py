"""Operators for preparing training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package with their code, so workers need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
