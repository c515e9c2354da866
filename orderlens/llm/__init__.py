"""Operators for preparing training text. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Python functions travel to executors with their code, so no installation is needed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
