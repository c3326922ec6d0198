"""Preparing text for language models: thirteen operators over documents, pages and conversations.

Functions of this package travel to executors by value, so a cluster's workers need
numpy and pyarrow but no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
