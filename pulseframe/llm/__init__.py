"""Operators of a training-data pipeline over documents, pages and conversations."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this subpackage by value, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from pulseframe.llm.queries import ORACLE, QUERIES  # noqa: E402

__all__ = ["ORACLE", "QUERIES"]
