"""Training-data operators: scoring, deduplication, packing, archives and
similarity search over document tables.

Functions that run inside tasks are pickled by value, so executors need the
third-party libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
