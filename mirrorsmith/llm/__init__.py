"""Operators of a training-data pipeline: mixing, archives, quality, search,
near duplicates, toxicity, packing, line dedup and fingerprints.

Nothing outside this package imports it.  Functions that run inside tasks are
pickled by value, so executors need only Spark, numpy, pandas and pyarrow, not
a copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
