"""Training-data operators over the `documents`, `embeddings` and `labels` tables.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers are pickled by value, so workers need no import path to it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
