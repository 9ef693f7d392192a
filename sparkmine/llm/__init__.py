"""Operators of a training-data pipeline. Nothing else in the library imports this
subpackage; ``queries.py`` holds its registered queries.

Functions of this package that run in Python workers travel by value, so executors need
numpy, pandas and the public libraries, but not this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
