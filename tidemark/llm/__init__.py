"""Operators for preparing training text at scale, one module each (see README, "llm").

Nothing outside this folder imports it. Python functions of this package travel to the executors
by value, so a cluster needs the third-party libraries only, not a copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
