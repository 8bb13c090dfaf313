"""Column expressions. All are built-in Spark functions, so they stay inside generated code."""

from rillflow.functions.formats import co_group_line, count_document, count_json, group_line, list_text
from rillflow.functions.records import ALARM_SCHEMA, as_int, is_bad_record, parse_text, to_record_json, typed_record
from rillflow.functions.text import (
    delimited_field,
    key_value_text,
    location_code,
    to_text,
    to_utf8,
    tokens,
    utf16_length,
    valid_location,
)

__all__ = [
    "ALARM_SCHEMA",
    "as_int",
    "co_group_line",
    "count_document",
    "count_json",
    "delimited_field",
    "group_line",
    "is_bad_record",
    "key_value_text",
    "list_text",
    "location_code",
    "parse_text",
    "to_record_json",
    "to_text",
    "to_utf8",
    "tokens",
    "typed_record",
    "utf16_length",
    "valid_location",
]
