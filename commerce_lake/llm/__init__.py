"""Operators for preparing training data: formatting, filtering, deduplication, packing."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Tasks carry this subpackage's functions with them, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
