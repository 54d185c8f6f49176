"""JSON values inside a record, and the views predicates and functions take.

A record is one JSON text per row. It is parsed once to ``VARIANT``; a path
into it is a :class:`Json` value with four views: ``text`` for equality and
string functions, ``number`` for ordering, ``array`` for joining and ``value``
(the typed variant) for output. Missing keys and JSON null are both SQL NULL
in every view but ``value``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")
_JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
# White space beyond ASCII that may wrap a numeric text.
_WIDE_SPACE = "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# Numeric spellings that do contain one of the letters d and f.
_LETTERED_NUMBER = r"(?i)^[+-]?(inf|infinity|0x[0-9a-f]*\.?[0-9a-f]*p[+-]?[0-9]+)$"


def json_path(path: str) -> str:
    """``Parent.Child.0`` as a Spark JSON path, ``$.Parent.Child[0]``."""
    out = "$"
    for part in path.split("."):
        if part.isdigit():
            out += f"[{part}]"
        elif _IDENTIFIER.match(part):
            out += f".{part}"
        elif "'" in part:
            out += f'["{part}"]'
        else:
            out += f"['{part}']"
    return out


class Views:
    """Decides which views of a record become shared columns.

    A ruleset is bound twice: the first round counts how often each view is
    asked for, the second one reads those asked for more than once from a
    projected column, so a path many rules test is extracted once per record.
    """

    def __init__(self) -> None:
        self.uses: Counter[tuple] = Counter()
        self.columns: dict[tuple, str] = {}
        self._builders: dict[tuple, tuple[int, Callable[[], Column]]] = {}
        self._made: dict[tuple, Column] = {}

    def view(self, key: tuple, level: int, build: Callable[[], Column], uses: int = 1) -> Column:
        self.uses[key] += uses
        if key not in self._made:
            if key not in self.columns:
                self._builders[key] = (level, build)
            self._made[key] = F.col(self.columns[key]) if key in self.columns else build()
        return self._made[key]

    def share(self) -> None:
        """End the counting round: name a column for every view used twice."""
        for key, count in self.uses.items():
            if count > 1:
                self.columns[key] = f"__view{len(self.columns)}"
        self._made.clear()

    def project(self, df):
        """Add the shared columns; a view built on another comes one step later."""
        for step in sorted({self._builders[k][0] for k in self.columns}):
            added = {
                self.columns[k]: self._builders[k][1]()
                for k in self.columns
                if self._builders[k][0] == step
            }
            df = df.withColumns(added)
        return df


class Json:
    """A JSON value: ``source`` is a VARIANT column, ``path`` a place in it."""

    def __init__(self, source: Column, path: str | None = None, *, key: str = "doc",
                 views: Views | None = None, require: Callable[[Column, str], None] | None = None):
        self.source = source
        self.path = path
        self._spark_path = "$" if path is None else json_path(path)
        self._key = (key, path)
        self._views = views
        self._require = require

    def _view(self, kind: str, level: int, build: Callable[[], Column], uses: int = 1) -> Column:
        if self._views is None:
            return build()
        return self._views.view((*self._key, kind), level, build, uses)

    def _get(self, to: str) -> Column:
        return F.try_variant_get(self.source, self._spark_path, to)

    @property
    def text(self) -> Column:
        return self._text()

    def _text(self, uses: int = 1) -> Column:
        return self._view("text", 1, lambda: self._get("string"), uses)

    @property
    def number(self) -> Column:
        """What an ordering compares, see :func:`as_number`."""
        return self._view("number", 2, lambda: ordinal(self._text(uses=3)))

    @property
    def exact_number(self) -> Column:
        """As double only where the text is spelled as a JSON number."""
        return self._view("exact", 2, lambda: json_number(self._text(uses=2)))

    @property
    def array(self) -> Column:
        return self._view("array", 1, lambda: self._get("array<string>"))

    @property
    def value(self) -> Column:
        return self.source if self.path is None else self._get("variant")

    @property
    def value_or_null(self) -> Column:
        """The typed value with JSON null turned into SQL NULL."""
        return F.when(self.text.isNotNull(), self.value)

    @property
    def is_text(self) -> Column:
        return F.schema_of_variant(self.value) == "STRING"

    def require(self, condition: Column, reason: str) -> None:
        """Where ``condition`` does not hold the rule fails for the row, for the ``reason``, a few words after the path."""
        if self._require is not None:
            self._require(condition, f"{self._key[0] if self.path is None else self.path}: {reason}")


def parse_number(text: Column) -> Column:
    """Numeric text as double, NULL otherwise.

    Spark would read ``1d`` and ``1f`` as numbers; those are ordinary text here,
    so both letters are masked first and let through for infinities and
    hexadecimal spellings only.
    """
    masked = F.translate(text, "dDfF" + _WIDE_SPACE, "____" + " " * len(_WIDE_SPACE))
    special = F.when(F.trim(text).rlike(_LETTERED_NUMBER), text.try_cast("double"))
    return F.coalesce(masked.try_cast("double"), special)


def ordinal(text: Column) -> Column:
    """0 for what is no number, NULL for NaN, which is in no order."""
    return F.nanvl(F.coalesce(parse_number(text), F.lit(0.0)), F.lit(None).cast("double"))


def json_number(text: Column) -> Column:
    return F.when(text.rlike(_JSON_NUMBER), text.try_cast("double"))


def literal_number(value) -> float:
    """A Python literal as the number an ordering compares; 0 if it is none."""
    if value is None or isinstance(value, bool):
        return 0.0
    if isinstance(value, (int, float)):
        return float(value)
    text = str(value).strip()
    if "_" in text:
        return 0.0
    try:
        return float(text)
    except ValueError:
        return 0.0


def as_text(x) -> Column:
    if isinstance(x, Json):
        return x.text
    if isinstance(x, Column):
        return x.cast("string")
    if x is None:
        return F.lit(None).cast("string")
    if isinstance(x, bool):
        return F.lit("true" if x else "false")
    return F.lit(str(x))


def as_number(x) -> Column:
    """For ordering: 0 where missing, boolean or no number; NULL for NaN."""
    if isinstance(x, Json):
        return x.number
    if isinstance(x, Column):
        return ordinal(x.cast("string"))
    return F.lit(literal_number(x))


def as_output(x) -> Column:
    """For JSON output: keeps the JSON type."""
    if isinstance(x, Json):
        return x.value
    return x if isinstance(x, Column) else F.lit(x)


def as_variant(x) -> Column:
    if isinstance(x, Json):
        return x.value_or_null
    return (x if isinstance(x, Column) else F.lit(x)).cast("variant")


def parse(record: Column | str = "record") -> Column:
    """The record as VARIANT; NULL if it is not valid JSON."""
    return F.try_parse_json(F.col(record) if isinstance(record, str) else record)


def json_get(path: str, record: Column | str = "record") -> Column:
    """Text at a path of a JSON text column; for one-off use on a plain frame."""
    return F.get_json_object(F.col(record) if isinstance(record, str) else record, json_path(path))


def json_value(path: str, doc: Column | str = "doc") -> Json:
    """The value at a path of an already parsed VARIANT column."""
    return Json(F.col(doc) if isinstance(doc, str) else doc, path)
