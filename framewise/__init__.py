"""framewise: composable ``DataFrame -> DataFrame`` analytics operators on Spark.

Every operator is a plain function taking a DataFrame first, so chains read
like ``df.transform(top_k_filter, "event_type", 3).transform(...)``.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package that run on executors travel by value: the executors need no copy of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
