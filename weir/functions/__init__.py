"""Expressions: JSON values, predicates and scalar functions."""

from .predicates import all_of, any_of, eq, ge, gt, le, lt, ne
from .scalar import (
    basename, concat, first_non_null, getdir, getrand, gettime, join_, rand_, sprintf, str_, time_,
)
from .values import Json, json_get, json_path, json_value, parse

__all__ = [
    "Json", "all_of", "any_of", "basename", "concat", "eq", "first_non_null", "ge", "getdir",
    "getrand", "gettime", "gt", "join_", "json_get", "json_path", "json_value", "le", "lt", "ne",
    "parse", "rand_", "sprintf", "str_", "time_",
]
