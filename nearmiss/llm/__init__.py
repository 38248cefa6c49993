"""Operators of a training-data pipeline.

Every operator is a function over DataFrames; ``queries.QUERIES`` holds the thin
``opN_<name>`` queries over the driver tables. Nothing else in the library imports
this subpackage.

Functions that run in Python workers are shipped by value, so that the workers need
no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
