"""Rental-market and spatial-panel analytics as Spark DataFrame operators."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

__version__ = "0.1.0"

# functions that run on executors travel with the plan, so executors need not have the package
register_pickle_by_value(sys.modules[__name__])
