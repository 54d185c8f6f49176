"""Building the outbound JSON of a record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.values import Json, as_output


class _SendAll:
    def __repr__(self) -> str:
        return "SEND_ALL"


# As the whole projection, or anywhere in it: forward the record unchanged.
SEND_ALL = _SendAll()


def fields_of(projection) -> dict[str, object] | _SendAll:
    """A projection as name → expression.

    Takes a mapping, a sequence of expressions and ``(name, expression)``
    pairs, or ``SEND_ALL``. A JSON value without a name is called by its path.
    """
    if projection is None:
        return {}
    if isinstance(projection, _SendAll):
        return projection
    if isinstance(projection, Mapping):
        items = list(projection.items())
    else:
        items = []
        for item in projection if isinstance(projection, Sequence) else [projection]:
            if isinstance(item, _SendAll):
                items.append((None, item))
            elif isinstance(item, tuple):
                items.append(item)
            elif isinstance(item, Json) and item.path is not None:
                items.append((item.path, item))
            else:
                raise ValueError(f"give a name to {item!r}")
    for _, value in items:
        if isinstance(value, _SendAll):
            return value
    return dict(items)


def outbound(projection, record: Column | str = "record") -> Column:
    """The outbound text: fields sorted by name, absent ones as JSON null."""
    fields = fields_of(projection)
    if isinstance(fields, _SendAll):
        return F.col(record) if isinstance(record, str) else record
    if not fields:
        return F.lit("{}")
    columns = [as_output(fields[name]).alias(name) for name in sorted(fields)]
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
