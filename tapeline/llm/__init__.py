"""Operators for training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: functions defined in it are sent whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
