"""Operators for preparing training text: deduplication, labelling, packing, archives.

Nothing outside this folder imports it. What runs inside Python workers travels with the
tasks, so executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
