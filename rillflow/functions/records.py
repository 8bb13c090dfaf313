"""JSON text to typed records and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The alarm record.
ALARM_SCHEMA = T.StructType(
    [
        T.StructField("alarmid", T.StringType()),
        T.StructField("alarmTitle", T.StringType()),
        T.StructField("deviceModel", T.StringType()),
        T.StructField("alarmSource", T.IntegerType()),
        T.StructField("alarmMsg", T.StringType()),
    ]
)

CORRUPT = "_corrupt_record"


def as_int(text: Column) -> Column:
    """Whole numbers in any notation (``3``, ``3.0``, ``1e3``) as INT; anything else NULL."""
    number = text.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def _typed(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.IntegerType):
        return as_int(text)
    return text.try_cast(data_type)


def parse_text(value: Column, schema: T.StructType = ALARM_SCHEMA) -> Column:
    """Struct of the fields of JSON object text, all as text, plus the raw text if it is malformed.

    Reading text first makes ``"3"`` and ``3.0`` valid integers. Unknown fields are ignored, missing
    ones are NULL, and names are case-sensitive.
    """
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in [*schema.names, CORRUPT]])
    return F.from_json(value, as_text, {"columnNameOfCorruptRecord": CORRUPT, "allowUnquotedFieldNames": "true"})


def object_count(value: Column) -> Column:
    """How many JSON values the text holds, separated by commas; NULL if anything else follows one of them."""
    return F.size(F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<struct<_any:string>>", {"allowUnquotedFieldNames": "true"}))


def typed_record(parsed: Column, schema: T.StructType = ALARM_SCHEMA) -> Column:
    """The fields of ``parse_text`` cast to their types; what does not fit becomes NULL."""
    return F.struct(*[_typed(parsed[f.name], f.dataType).alias(f.name) for f in schema])


def is_bad_record(value: Column, parsed: Column, schema: T.StructType = ALARM_SCHEMA, objects: Column | None = None) -> Column:
    """True for NULL, blank or malformed text, anything but exactly one object, and a field not fitting its type.

    Text after the object, another object too, makes a row bad. ``objects`` is ``object_count`` if it is known already.
    """
    single = F.coalesce((object_count(value) if objects is None else objects) == 1, F.lit(False))
    bad = ~single | parsed.isNull() | parsed[CORRUPT].isNotNull() | ~F.rtrim(value, F.lit(" \t\r\n")).endswith("}")
    for field in schema:
        if not isinstance(field.dataType, T.StringType):
            text = parsed[field.name]
            bad = bad | (text.isNotNull() & _typed(text, field.dataType).isNull())
    return bad


def to_record_json(*fields: Column | str) -> Column:
    """JSON object of the given columns; NULL fields are left out."""
    return F.to_json(F.struct(*fields))
