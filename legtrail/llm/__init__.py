"""Operators for training-data pipelines over tables of documents and vectors.

Nothing outside this folder and ``corpus_pipeline.py`` imports it. Functions that run in Python tasks are
shipped by value, so executors need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
