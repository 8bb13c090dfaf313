"""Output text of counts, groups and co-groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillflow.functions.text import NULL_TEXT


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(NULL_TEXT))


def count_json(key: Column, n: Column, quoted: bool = False, escape: bool = False) -> Column:
    """``{"key":n}``, or ``{"key": "n"}`` when ``quoted``. Keys are written as they are unless ``escape``."""
    if escape:
        return F.to_json(F.create_map(_text(key), n.cast("string") if quoted else n))
    # The two output formats.
    before, after = ('": "', '"}') if quoted else ('":', "}")
    return F.concat(F.lit('{"'), _text(key), F.lit(before), _text(n), F.lit(after))


def count_document(key: Column, n: Column) -> Column:
    """One-field JSON document ``{key: n}`` with the key escaped."""
    return F.to_json(F.create_map(_text(key), n))


def list_text(values: Column) -> Column:
    """``[a, b]``."""
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), ", ", NULL_TEXT), F.lit("]"))


def group_line(key: Column, values: Column) -> Column:
    """``key : [a, b]``."""
    return F.concat(_text(key), F.lit(" : "), list_text(values))


def co_group_line(key: Column, lists: Sequence[Column], trailing_cr: bool = False) -> Column:
    """``key;[a];[b];`` with one list per input, and optionally a carriage return."""
    parts = [_text(key), F.lit(";")]
    for values in lists:
        parts += [list_text(values), F.lit(";")]
    if trailing_cr:
        parts.append(F.lit("\r"))
    return F.concat(*parts)
