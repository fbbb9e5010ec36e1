"""Message envelope: encode readings as keyed JSON messages (S3) and decode
them back into typed columns (S2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firesight.functions.columns import iso_ts, nan_to_null, q
from firesight.spec import DEFAULT_SPEC, SENSOR_COLUMNS, SensorSpec

JSON_OPTIONS = {"ignoreNullFields": "false"}


def encode(readings: DataFrame, spec: SensorSpec = DEFAULT_SPEC, keep=()) -> DataFrame:
    """S3: one message per reading: key = node id, value = JSON document.

    Null fields are written as JSON null (as a Python producer does); the
    event time travels as ISO-8601 text with milliseconds and 'Z'. Columns
    named in ``keep`` are passed through beside the message.
    """
    fields = []
    for f in spec.schema.fields:
        c = q(f.name)
        if f.name == "ingest_ts" and not isinstance(readings.schema["ingest_ts"].dataType, T.StringType):
            c = iso_ts(c)
        fields.append(c.alias(f.name))
    return readings.select(F.col("node_id").alias("key"),
                           F.to_json(F.struct(*fields), JSON_OPTIONS).alias("value"), *keep)


def decode(messages: DataFrame, spec: SensorSpec = DEFAULT_SPEC, value_col: str = "value",
           keep_rejects: bool = False) -> DataFrame:
    """Bytes or text -> JSON -> typed reading columns.

    Permissive: a wrongly typed field becomes null, an unparsable document a
    row of nulls. NaN sensor values become null (one bad reading must not
    poison a node's running statistics). With ``keep_rejects`` a boolean
    ``_rejected`` column marks documents without a node id, and ``_key`` and
    ``_raw`` keep the message, for ``split_rejects``.
    """
    text = F.col(value_col).cast("string")
    key = F.col("key").cast("string") if "key" in messages.columns else F.lit(None).cast("string")
    parsed = messages.select(F.from_json(text, spec.schema, {"mode": "PERMISSIVE"}).alias("d"), text.alias("_raw"),
                             key.alias("_key"))
    cols = [nan_to_null(F.col(f"d.`{c}`")).alias(c) if c in SENSOR_COLUMNS else F.col(f"d.`{c}`").alias(c)
            for c in spec.schema.fieldNames()]
    out = parsed.select(*cols, F.col("d.node_id").isNull().alias("_rejected"), "_key", "_raw")
    if keep_rejects:
        return out
    return split_rejects(out)[0]


def split_rejects(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected raw documents) of a ``decode(keep_rejects=True)`` frame."""
    good = decoded.filter(~F.col("_rejected")).drop("_rejected", "_key", "_raw")
    bad = decoded.filter(F.col("_rejected")).select(F.col("_key").alias("key"), F.col("_raw").alias("document"))
    return good, bad
