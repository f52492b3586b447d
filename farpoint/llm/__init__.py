"""Training-data operators: quality, dedup, mixing, tokenising, packing, chat.

Nothing else in the library imports this subpackage. Its task functions are
pickled by value, so executors need no copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
