"""Operators for preparing training corpora.

Nothing else in the library imports this subpackage.  Its task functions are sent to the
executors by value, so executors need the third-party libraries but not this package.
"""
from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
