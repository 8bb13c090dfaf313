"""DataFrame-to-DataFrame operators."""

from rillflow.operators.filters import route, route_output, where_location, where_prefix, where_valid_location
from rillflow.operators.keyed import PAGE_SIZE, co_group, count_per_element, group_by_key
from rillflow.operators.sets import cap_rows, flatten, take_any
from rillflow.operators.taps import map_records, tap, tapped
from rillflow.operators.transforms import (
    ParsedRecords,
    extract_field,
    parse_records,
    require_non_null,
    strip_metadata,
    tag_records,
    tokenise,
    with_location,
)

__all__ = [
    "PAGE_SIZE",
    "ParsedRecords",
    "cap_rows",
    "co_group",
    "count_per_element",
    "extract_field",
    "flatten",
    "group_by_key",
    "map_records",
    "parse_records",
    "require_non_null",
    "route",
    "route_output",
    "strip_metadata",
    "tag_records",
    "take_any",
    "tap",
    "tapped",
    "tokenise",
    "where_location",
    "where_prefix",
    "where_valid_location",
    "with_location",
]
