"""Exploratory analytics on Spark DataFrames.

Every operator takes DataFrames and column names and gives back a DataFrame
(or a small named tuple of them).  ``functions`` holds the shared building
blocks, ``sources`` the readers and writers, ``operators`` the analyses and
``plans`` the workflows made of several operators.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run in tasks travel with the task, so that
# executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
