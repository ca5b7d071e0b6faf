"""Operators of a training-data pipeline over documents and web pages.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` applies them to the
benchmark tables under the names the driver calls.
"""

import sys

from pyspark import cloudpickle

# Workers get these functions by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
