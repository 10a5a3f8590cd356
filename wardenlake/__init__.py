"""Network-security analytics on Spark: netflow, DNS and web-proxy logs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in tasks travel by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
