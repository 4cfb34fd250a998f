"""Operators for building language-model training data."""

import sys

from pyspark import cloudpickle

# functions of this package travel with the tasks that call them: executors need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
