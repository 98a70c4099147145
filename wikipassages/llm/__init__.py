"""Training-data operators: tokenizing, filtering, de-duplication, packing and scoring of text.

The functions that run inside tasks are shipped by value, so executors need
no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
