"""Recommendation and semantic retrieval over a catalogue-and-ratings lakehouse, on PySpark."""

import sys

from pyspark import cloudpickle

# Functions that run inside Python workers travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
