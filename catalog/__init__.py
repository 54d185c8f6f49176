"""Every operator as a query over the given tables, with its SQL counterpart."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

from . import expressions, flow, routing, state  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
