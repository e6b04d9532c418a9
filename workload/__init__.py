"""The registered queries: this library's operators over the supplied tables."""

import sys

from pyspark import cloudpickle

# As in treeferry: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
