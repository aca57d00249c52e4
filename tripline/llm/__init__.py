"""Operators for the preparation of training data, over tables of documents (``doc_id``, ``text`` and others)."""

import sys

from pyspark import cloudpickle

# Executors get the functions themselves, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
