"""Operators for preparing training text: filters, near-duplicates, packing, scoring.

Nothing else in the library imports this folder.  Functions that run inside tasks are
sent by value, so executors need the public libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
