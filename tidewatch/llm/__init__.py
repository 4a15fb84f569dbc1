"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# functions run by tasks travel with them: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
