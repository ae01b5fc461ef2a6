"""Corpus operators for training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Task functions travel whole, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
