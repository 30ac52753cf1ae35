"""Ledger rows <-> JSON messages.

Encoding casts every field to its raw-schema type and serialises with
``to_json`` (JVM side, no Python per row); decoding is ``from_json`` with
the same schema, so batch and stream rows have one schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..spec import RAW_SCHEMA


def message_struct(schema: StructType = RAW_SCHEMA) -> Column:
    return F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def to_messages(df: DataFrame, schema: StructType = RAW_SCHEMA, key: str | None = None) -> DataFrame:
    """One JSON text ``value`` per row (plus an optional string ``key``)."""
    cols = [F.to_json(message_struct(schema)).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def parse_messages(messages: DataFrame, schema: StructType = RAW_SCHEMA, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode JSON text into the schema's columns, keeping the raw text (and the columns ``keep``).

    Parsing is permissive: malformed text, or a field of the wrong type,
    yields nulls (in the whole record or that field) rather than an error;
    :func:`valid_messages` decides which rows are usable.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema, {"mode": "PERMISSIVE"})
    return messages.select(F.col(value).cast("string").alias("raw_value"), parsed.alias("msg"), *keep).select(
        "raw_value", *keep, "msg.*"
    )


def valid_messages(parsed: DataFrame, required: tuple[str, ...] = ("step", "type", "amount", "nameOrig", "nameDest", "isFraud")) -> Column:
    """True when every required field decoded to a non-null value."""
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return cond


def publish_messages(messages: DataFrame, target: str, fmt: str = "text", options: dict | None = None) -> None:
    """Write messages to a topic (``fmt='kafka'``, ``options`` carry
    ``kafka.bootstrap.servers`` and ``topic``) or to text files."""
    writer = messages.write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("append").save(target)
