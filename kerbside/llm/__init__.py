"""Operators for preparing training text: extraction, quality, deduplication, mixing, packing.

Functions that run inside tasks are shipped by value, so that executors need nothing of this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
