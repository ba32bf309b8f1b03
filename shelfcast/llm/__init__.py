"""Operators for preparing training text, their queries and their SQL.

Functions that run in Python workers are sent by value, so workers need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
