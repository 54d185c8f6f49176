"""Typed predicates. None of them ever yields NULL."""

from __future__ import annotations

import math
import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import Json, as_number, as_text, json_number, literal_number

_EXACT_DOUBLE = 2**53


def _is_literal(x) -> bool:
    return not isinstance(x, (Column, Json))


def _exact_number(x) -> Column:
    return x.exact_number if isinstance(x, Json) else json_number(as_text(x))


def exact_literal(x) -> float | None:
    """The literal as a number if it is one and a double holds it exactly."""
    if isinstance(x, bool):
        return None
    try:
        value = float(x)
    except (TypeError, ValueError):
        return None
    return value if abs(value) < _EXACT_DOUBLE else None


def eq(left, right) -> Column:
    """Typed equality; a literal ``None`` or ``"null"`` tests for absence."""
    text = as_text(left)
    if _is_literal(right):
        if right is None or right == "null":
            return text.isNull()
        same = text.eqNullSafe(as_text(right))
        value = exact_literal(right)
        if value is None or math.isnan(value):
            return same
        return same | F.coalesce(_exact_number(left) == F.lit(value), F.lit(False))
    same = text.eqNullSafe(as_text(right))
    return same | F.coalesce(_exact_number(left) == _exact_number(right), F.lit(False))


def ne(left, right) -> Column:
    return ~eq(left, right)


def _ordered(left, right, compare) -> Column:
    # NaN is NULL on both sides, so an ordering with NaN comes out false.
    if _is_literal(right):
        right = literal_number(right)
        if math.isnan(right):
            return F.lit(False)
    else:
        right = as_number(right)
    return F.coalesce(compare(as_number(left), right), F.lit(False))


def lt(left, right) -> Column:
    return _ordered(left, right, operator.lt)


def le(left, right) -> Column:
    return _ordered(left, right, operator.le)


def gt(left, right) -> Column:
    return _ordered(left, right, operator.gt)


def ge(left, right) -> Column:
    return _ordered(left, right, operator.ge)


def all_of(*conditions: Column) -> Column:
    """Every line holds; true when there are none."""
    return reduce(operator.and_, conditions) if conditions else F.lit(True)


def any_of(*conditions: Column) -> Column:
    """At least one alternative of a line holds."""
    if not conditions:
        raise ValueError("any_of needs at least one condition")
    return reduce(operator.or_, conditions)
