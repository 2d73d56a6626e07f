"""Payloads to records, with everything unreadable set aside and named."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.functions import codec
from tocsin.schema import REQUEST_FIELDS, TASK_FIELDS
from tocsin.session import DECODE_CONF, apply_conf


class Decoded(NamedTuple):
    """What could be read, what was set aside, and both in one frame: there `reason` and `raw` are
    null for what could be read, and its fields are null for what was set aside."""

    valid: DataFrame
    quarantine: DataFrame
    tagged: DataFrame


def _computed_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that the optimizer will not copy into each filter and projection above it.

    It does that to plain columns, which would parse a payload again for every use of a field.
    """
    return rows.withColumn(name, F.explode(F.array(value)))


def _decode(payloads: DataFrame, fields: list[tuple[str, str, str]]) -> Decoded:
    apply_conf(payloads.sparkSession, DECODE_CONF)
    envelope = [F.col(name) for name in payloads.columns if name != "value"]
    text = codec.payload_text(F.col("value"))
    parsed = _computed_once(payloads, "_parsed", codec.parse_payload(text, fields))
    tags = F.struct(
        *[F.schema_of_variant(F.col("_parsed")[key]).alias(column) for column, key, _ in fields]
    )
    tagged = _computed_once(parsed, "_tag", tags)

    def of_each(expression) -> list[Column]:
        return [
            expression(F.col("_parsed")[key], F.col("_tag")[column], kind).alias(column)
            for column, key, kind in fields
        ]

    reason = F.coalesce(
        codec.envelope_error(text, F.col("_parsed")),
        *of_each(codec.field_error),
        codec.id_error(F.col("_tag")["id"]),
    )
    judged = _computed_once(tagged, "reason", reason)
    good = F.col("reason").isNull()
    known = [F.when(good, value).alias(name) for value, (name, _, _) in zip(of_each(codec.field_value), fields)]
    raw = F.col("value").alias("raw")
    return Decoded(
        valid=judged.where(good).select(*of_each(codec.field_value), *envelope),
        quarantine=judged.where(~good).select(raw, "reason", *envelope),
        tagged=judged.select(*known, "reason", F.when(~good, F.col("value")).alias("raw"), *envelope),
    )


def decode_requests(payloads: DataFrame) -> Decoded:
    """Five-field requests from a `value` column; other columns travel along."""
    return _decode(payloads, REQUEST_FIELDS)


def decode_tasks(payloads: DataFrame) -> Decoded:
    """Full task records from a `value` column; other columns travel along."""
    return _decode(payloads, TASK_FIELDS)
