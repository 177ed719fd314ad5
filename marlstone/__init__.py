"""A Spark-native engine for tabular time series, bronze documents and training text.

Everything is a DataFrame plan; Python runs only in Arrow batches, and only
where no built-in expression has the semantics.
"""

import sys

from pyspark import cloudpickle

# Python workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
