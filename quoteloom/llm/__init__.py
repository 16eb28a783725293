"""Operators for building training corpora: filters, dedup, search, extraction, tokens.

Functions that run inside tasks travel to the executors with their code, so nothing
of this package has to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
