"""Operators of a training-data pipeline. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors with the job that uses them, so that the
# executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
