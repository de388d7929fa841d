"""Operators that prepare text corpora for training language models; nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# executors get these functions with the tasks, so they need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
