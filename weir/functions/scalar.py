"""Scalar functions. Arguments are JSON values, Columns or Python literals."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import Json, as_text, as_variant

# Separator names and what they stand for.
SEPARATORS = {
    "COMMA": ",",
    "SEMICOLON": ";",
    "COLON": ":",
    "DASH": "-",
    "HYPTHEN": "-",
    "HYPHEN": "-",
    "DOT": ".",
    "PERIOD": ".",
}


def str_(x) -> Column:
    return as_text(x)


def _shown(x) -> Column:
    return F.coalesce(as_text(x), F.lit("null"))


def concat(*xs) -> Column:
    """All arguments as one text; an absent one shows as ``null``."""
    if not xs:
        return F.lit("")
    return F.concat(*[_shown(x) for x in xs])


def sprintf(template, *xs) -> Column:
    """``template`` with each ``%v`` replaced by the next argument.

    ``%%`` is a literal percent sign, other text is kept, surplus arguments are
    ignored. A fixed template becomes a plain concatenation. A template read
    from the record is NULL, and no match in a rule, if it wants more arguments
    than there are.
    """
    if not isinstance(template, str):
        return _sprintf_by_row(template, xs)
    parts, used, start = [], 0, 0
    for mark in re.finditer(r"%%|%v", template):
        parts.append(F.lit(template[start:mark.start()]))
        start = mark.end()
        if mark.group() == "%%":
            parts.append(F.lit("%"))
            continue
        if used == len(xs):
            raise ValueError(f"template {template!r} needs more than {used} arguments")
        parts.append(_shown(xs[used]))
        used += 1
    parts.append(F.lit(template[start:]))
    return F.concat(*parts)


def _sprintf_by_row(template, xs) -> Column:
    # Escaped percent signs step aside while the text is cut at its placeholders.
    aside = "\ue000"
    pieces = F.split(F.replace(as_text(template), F.lit("%%"), F.lit(aside)), "%v")
    wanted = F.size(pieces) - 1
    enough = wanted.between(0, len(xs))
    if isinstance(template, Json):
        template.require(enough, "more placeholders than values, or no template")
    shown = F.array(*[_shown(x) for x in xs]) if xs else F.array().cast("array<string>")
    filled = F.zip_with(pieces, F.slice(shown, F.lit(1), F.when(enough, wanted).otherwise(0)),
                        lambda piece, x: F.concat(F.replace(piece, F.lit(aside), F.lit("%")), F.coalesce(x, F.lit(""))))
    return F.when(enough, F.array_join(filled, ""))


def _separator(style: str) -> str:
    return "\\" if style.strip().upper() == "WINDOWS" else "/"


def _path_text(path) -> tuple[Column, Column]:
    text = as_text(path)
    usable = text.isNotNull() & (text != "null")
    if isinstance(path, Json):
        usable = usable & path.is_text
    return text, usable


def basename(path, style: str = "") -> Column:
    """Text after the last separator; the whole text if there is none."""
    text, usable = _path_text(path)
    return F.when(usable, F.substring_index(text, _separator(style), -1)).otherwise("")


def getdir(path, style: str = "") -> Column:
    """Text before the last separator; empty if there is none."""
    sep = _separator(style)
    text, usable = _path_text(path)
    kept = F.length(text) - F.length(F.substring_index(text, sep, -1)) - 1
    return F.when(usable & text.contains(sep), F.left(text, kept)).otherwise("")


def join_(separator: str, array) -> Column:
    """Array elements as one text; NULL if the value is no array.

    Inside a rule a value that is no array keeps the row from matching.
    """
    sep = SEPARATORS.get(separator.upper(), "")
    if isinstance(array, Json):
        array.require(array.array.isNotNull(), "no array")
        elements = array.array
    else:
        elements = array.cast("array<string>")
    return F.array_join(elements, sep, "<nil>")


def first_non_null(*xs):
    """The first argument that is present, else an empty text."""
    if not xs:
        return F.lit("")
    if any(isinstance(x, Json) for x in xs):
        empty = F.lit("").cast("variant")
        return Json(F.coalesce(*[as_variant(x) for x in xs], empty), key="first_non_null")
    return F.coalesce(*[x if isinstance(x, Column) else F.lit(x) for x in xs], F.lit(""))


def rand_(kind: str = "UINT64", seed: int | None = None) -> Column:
    """A random number per row: FLOAT32, FLOAT64 in [0, 1), UINT32 or UINT64."""
    def draw(offset: int = 0) -> Column:
        return F.rand() if seed is None else F.rand(seed + offset)

    word = 4294967296
    if kind == "FLOAT32":
        # 24 random bits: what a float32 below 1 holds without rounding up.
        return (F.floor(draw() * 16777216) / 16777216).cast("float")
    if kind == "FLOAT64":
        return draw()
    if kind == "UINT32":
        return F.floor(draw() * word).cast("bigint")
    high = F.floor(draw() * word).cast("decimal(20,0)")
    low = F.floor(draw(1) * word).cast("decimal(20,0)")
    return (high * F.lit(word).cast("decimal(10,0)") + low).cast("decimal(20,0)")


def time_(unit: str = "MS", at: Column | None = None) -> Column:
    """Hour, minute, second, or epoch milliseconds of ``at`` (default: now).

    "Now" is fixed per query, or per micro-batch of a stream.
    """
    moment = F.current_timestamp() if at is None else at.cast("timestamp")
    if unit == "H":
        return F.hour(moment)
    if unit == "M":
        return F.minute(moment)
    if unit == "S":
        return F.second(moment)
    return F.unix_millis(moment)


getrand = rand_
gettime = time_
