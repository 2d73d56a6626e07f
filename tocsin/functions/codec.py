"""JSON payloads to typed columns and back, with built-in functions only.

A payload is parsed once, each wanted field as a variant: its type tag tells a number from a
text, a boolean or a nested value, so coercions and rejections can follow the data contract
instead of turning bad input into nulls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tocsin.schema import (
    BAD_TYPE,
    BAD_UUID,
    EMPTY,
    MALFORMED,
    MISSING_ID,
    OVERFLOW,
    SPARK_TYPE,
)

_PARSE_OPTIONS = {
    "mode": "PERMISSIVE",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "columnNameOfCorruptRecord": "_corrupt",
}
_BYTE_ORDER_MARK = "\ufeff"
_UUID_TEXT = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
_UUID_BASE64 = "^[A-Za-z0-9+/]{22}==$"
_INSTANT_TEXT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d{1,9})?)?(Z|[+-]\d\d(:?\d\d)?)$"


def payload_text(value: Column) -> Column:
    """The payload as text, without a leading byte order mark."""
    text = value.cast("string")
    return F.when(text.startswith(_BYTE_ORDER_MARK), F.substring(text, 2, 2**31 - 1)).otherwise(text)


def parse_payload(text: Column, fields: list[tuple[str, str, str]]) -> Column:
    """A struct of variants, one per field, plus `_corrupt`; unknown fields are skipped."""
    schema = ", ".join(f"`{key}` variant" for _, key, _ in fields)
    return F.from_json(text, f"{schema}, _corrupt string", _PARSE_OPTIONS)


def envelope_error(text: Column, parsed: Column) -> Column:
    """Why the payload as a whole cannot be read; null when it can."""
    return (
        F.when(text.isNull() | F.trim(text).isin("", "null"), F.lit(EMPTY))
        .when(~F.is_valid_utf8(text), F.lit(MALFORMED))
        .when(parsed.isNull() | parsed["_corrupt"].isNotNull(), F.lit(MALFORMED))
    )


def _get(field: Column, spark_type: str) -> Column:
    return F.try_variant_get(field, F.lit("$"), spark_type)


def _trimmed(field: Column) -> Column:
    return F.btrim(_get(field, "string"), F.lit(" \t\r\n"))


def _is_null(tag: Column) -> Column:
    return tag.isNull() | (tag == "VOID")


def _is_nested(tag: Column) -> Column:
    return tag.startswith("OBJECT") | tag.startswith("ARRAY")


def _is_number(tag: Column) -> Column:
    return (tag == "BIGINT") | (tag == "DOUBLE") | tag.startswith("DECIMAL")


def _number(field: Column, tag: Column, spark_type: str) -> Column:
    """Numbers truncate toward zero; text is trimmed, and blank or `null` text is null."""
    text = _trimmed(field)
    return F.when(_is_number(tag), _get(field, spark_type)).when(
        (tag == "STRING") & ~text.isin("", "null"), text.try_cast(spark_type)
    )


def _number_error(field: Column, tag: Column, spark_type: str) -> Column:
    text = _trimmed(field)
    return (
        F.when(_is_null(tag), F.lit(None))
        .when(_is_number(tag), F.when(_get(field, spark_type).isNull(), F.lit(OVERFLOW)))
        .when(
            tag == "STRING",
            F.when(~text.isin("", "null") & text.try_cast(spark_type).isNull(), F.lit(BAD_TYPE)),
        )
        .otherwise(F.lit(BAD_TYPE))
    )


def _hex_as_uuid(digits: Column) -> Column:
    return F.concat_ws(
        "-",
        *[F.substring(digits, start, length) for start, length in [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]],
    )


def _uuid(field: Column) -> Column:
    """Canonical lower-case text, from the dashed form or 16 bytes in base 64."""
    text = _get(field, "string")
    return F.when(F.lower(text).rlike(_UUID_TEXT), F.lower(text)).when(
        text.rlike(_UUID_BASE64), _hex_as_uuid(F.lower(F.hex(F.unbase64(text))))
    )


def _instant(field: Column, tag: Column) -> Column:
    """ISO-8601 text with an offset, or seconds since the epoch as a number."""
    text = _get(field, "string")
    micros = F.try_multiply(_get(field, "decimal(38,9)"), F.lit(1_000_000)).try_cast("bigint")
    return F.when(
        tag == "STRING", F.when(text.rlike(_INSTANT_TEXT), text.try_cast("timestamp"))
    ).when(_is_number(tag), F.timestamp_micros(micros))


def _text_map(field: Column) -> Column:
    return F.transform_values(
        _get(field, "map<string,variant>"), lambda _, item: _get(item, "string")
    )


def _has_nested_value(field: Column) -> Column:
    return F.exists(
        F.map_values(_get(field, "map<string,variant>")),
        lambda item: F.coalesce(_is_nested(F.schema_of_variant(item)), F.lit(False)),
    )


def field_value(field: Column, tag: Column, kind: str) -> Column:
    """The typed value of a field; null when absent, blank or in error."""
    if kind == "text":
        return _get(field, "string")
    if kind == "uuid":
        return _uuid(field)
    if kind == "instant":
        return _instant(field, tag)
    if kind == "text_map":
        return F.when(tag.startswith("OBJECT"), _text_map(field))
    value = _number(field, tag, SPARK_TYPE[kind])
    return F.coalesce(value, F.lit(0).cast(SPARK_TYPE[kind])) if kind.endswith("0") else value


def field_error(field: Column, tag: Column, kind: str) -> Column:
    """Why a field cannot be read; null when it can."""
    if kind == "text":
        return F.when(_is_nested(tag), F.lit(BAD_TYPE))
    if kind == "uuid":
        return F.when(~_is_null(tag) & _uuid(field).isNull(), F.lit(BAD_UUID))
    if kind == "instant":
        blank = (tag == "STRING") & (_trimmed(field) == "")
        unread = ~_is_null(tag) & ~blank & _instant(field, tag).isNull()
        return F.when(unread, F.when(_is_number(tag), F.lit(OVERFLOW)).otherwise(F.lit(BAD_TYPE)))
    if kind == "text_map":
        return F.when(
            ~_is_null(tag) & (~tag.startswith("OBJECT") | _has_nested_value(field)), F.lit(BAD_TYPE)
        )
    return _number_error(field, tag, SPARK_TYPE[kind])


def id_error(tag: Column) -> Column:
    return F.when(_is_null(tag), F.lit(MISSING_ID))


def encode(fields: list[tuple[str, str, str]], values: list[Column] | None = None) -> Column:
    """The record as JSON text: every field present, nulls written, instants in ISO-8601.

    `values` are the field values in order; by default the columns of the same names.
    """
    values = values or [F.col(column) for column, _, _ in fields]
    record = F.struct(*[value.alias(key) for value, (_, key, _) in zip(values, fields)])
    return F.to_json(
        record,
        {
            "ignoreNullFields": "false",
            "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
            "timeZone": "UTC",
        },
    )
