"""Spark-native record linkage and text analytics, expressed as DataFrame plans.

Functions that run in Python workers are shipped by value, so executors need
nothing of this package on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
