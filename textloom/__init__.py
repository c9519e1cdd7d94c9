"""Corpus preparation and run analytics as plain DataFrame -> DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions handed to Python workers travel by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
