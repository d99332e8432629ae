"""Python functions of this package travel to the workers by value: these need not have it installed."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
