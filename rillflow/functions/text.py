"""Text expressions: delimited fields, location codes, tokens, key/value text, bytes.

Each expression mentions its input once where it can: Spark repeats the work for every mention when
it pushes a filter below the projection that computes it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The event-record layout and the text formats that results depend on.
LOCATION_FIELD = 21
NO_LOCATION = "NA"
UNKNOWN_MARK = "-"
KEY_VALUE_SEPARATOR = " # "
NULL_TEXT = "null"

# Characters of one and of two UTF-16 units; lengths of codes are counted in such units.
_NARROW = r"[^\t\x{10000}-\x{10FFFF}]"
_WIDE = r"[\x{10000}-\x{10FFFF}]"


def delimited_field(line: Column, index: int = 1, delimiter: str = ",", on_short: str = "fail") -> Column:
    """Field ``index`` of a delimited line; no quoting, and trailing empty fields do not count.

    A line without that field fails the job, or gives NULL with ``on_short="null"``. Splitting stops
    after the wanted field, so wide records cost no more than narrow ones.
    """
    if on_short not in ("fail", "null"):
        raise ValueError("on_short must be 'fail' or 'null'")
    fields = F.split(F.rtrim(line, F.lit(delimiter)), re.escape(delimiter), index + 2)
    found = F.get(fields, F.lit(index))
    if on_short == "null":
        return found
    message = F.concat(F.lit(f"no field {index} in line: "), F.coalesce(line, F.lit(NULL_TEXT)))
    return F.coalesce(found, F.raise_error(message))


def location_code(line: Column, position: int = LOCATION_FIELD, collapse: bool = True) -> Column:
    """Location code of a tab-separated record.

    The record needs a non-empty field after the code. Runs of tabs count as one separator unless
    ``collapse`` is off. A code longer than two keeps its first character; no code gives ``NA``.
    """
    # The whole code if it has at most two units, else its first character.
    short = rf"((?:{_NARROW}{{1,2}}|{_WIDE})(?=\t)|[^\t]|)[^\t]*+"
    before = rf"[^\t]*+(?:\t++[^\t]++){{{position - 1}}}\t++" if collapse else rf"(?:[^\t]*+\t){{{position}}}"
    found = F.regexp_extract_all(line, F.lit(rf"\A{before}{short}\t++[^\t]"), F.lit(1))
    return F.coalesce(F.get(found, F.lit(0)), F.lit(NO_LOCATION))


def valid_location(code: Column, literal: bool = False) -> Column:
    """True for two-character codes other than ``NA`` that do not start with ``-``.

    ``literal=True`` keeps only the codes that do start with ``-``.
    """
    mark = "=" if literal else "!"
    return code.rlike(rf"\A(?!{NO_LOCATION}\z)(?{mark}{UNKNOWN_MARK})(?:{_NARROW}{{2}}|{_WIDE})\z")


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, which exceeds the character count beyond the basic plane."""
    return (F.length(F.encode(text, "UTF-16BE")) / F.lit(2)).cast("int")


def tokens(line: Column) -> Column:
    """Array of the non-empty pieces between single spaces."""
    return F.array_remove(F.split(line, " "), "")


def key_value_text(key: Column, value: Column, separator: str = KEY_VALUE_SEPARATOR) -> Column:
    """``key # value``, with a missing side written as ``null``."""
    return F.concat(
        F.coalesce(key.cast("string"), F.lit(NULL_TEXT)),
        F.lit(separator),
        F.coalesce(value.cast("string"), F.lit(NULL_TEXT)),
    )


def to_utf8(value: Column) -> Column:
    """UTF-8 bytes of the text form of a value."""
    return F.encode(value.cast("string"), "UTF-8")


def to_text(data: Column) -> Column:
    """Text of UTF-8 bytes."""
    return data.cast("string")
