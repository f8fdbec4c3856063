"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this subpackage. ``queries.py`` holds the
registered ``opN_<name>`` queries; each operator has its own module.

Functions of this subpackage travel to Python workers by value, so executors
need the third-party packages but no copy of this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
