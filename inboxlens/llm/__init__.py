"""Operators for preparing training data at scale, and their queries.

Every operator takes and returns DataFrames. Row functions run inside Arrow
batches (``mapInArrow``); Spark deals out, shuffles and joins the work.
"""

import sys

from pyspark import cloudpickle

# Ship the row functions by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
