"""sparkloom: a Spark-first engine for training-corpus curation, mixing and scoring."""

from pyspark import cloudpickle as _cloudpickle

import sys as _sys

# Worker functions travel by value, so executors need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
