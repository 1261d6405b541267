"""Promotional-offer analytics on Spark DataFrames.

``sources``    readers, writers and the adapter over the test tables
``functions``  column expressions and scale-safe building blocks
``operators``  the analytics themselves, ``DataFrame -> DataFrame``
``plans``      registered queries with their SQL counterparts
"""

import sys

from pyspark import cloudpickle

# The few Arrow helpers travel to executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
