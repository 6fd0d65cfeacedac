"""Training-data operators: cleaning, deduplication, search, mixing and packing.

Every module holds one operator with its own general interface; ``queries``
derives the registered ``opN_*`` result sets from them. Nothing outside this
subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
