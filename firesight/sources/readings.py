"""Reading tables: the fixture view over ``events`` and plain table scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firesight.functions.columns import nan_to_null_all
from firesight.spec import SENSOR_COLUMNS

# Columns of the reading table, in order (ingest_ts is a timestamp here; the
# message form carries it as ISO text, see sources.envelope).
READING_COLUMNS = (*SENSOR_COLUMNS, "Fire", "node_id", "reading_index", "ingest_ts")


def q(name: str) -> Column:
    """Column reference that tolerates spaces and parentheses in the name."""
    return F.col(f"`{name}`")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a Parquet table; Catalyst prunes columns and pushes filters."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """A stored readings table; NaN sensor values are nulls from here on (P10)."""
    df = read_table(spark, path)
    return nan_to_null_all(df, [c for c in SENSOR_COLUMNS if c in df.columns])


def readings_from_events(events: DataFrame, keep=()) -> DataFrame:
    """Readings view over the driver's ``events`` table (FIXTURES.md section 4).

    Every column is a fixed expression of one event row, so the view is a
    narrow projection: it keeps the scan's partitioning and adds no shuffle.
    Columns named in ``keep`` are passed through.
    """
    k = F.get_json_object(F.col("props"), "$.k").try_cast("int")
    value = F.col("value")
    user = F.col("user_id")
    etype = F.col("event_type")
    null_d = F.lit(None).cast("double")
    temp = F.when(k == 0, null_d).otherwise(F.lit(20.0) + value / 10)
    gas = (F.when((etype == "signup") & (k >= 97), F.lit(1200000.0))
           .otherwise(F.lit(200000.0) - value * 600))
    co = F.when(etype == "error", value * 3).otherwise(value / 10)
    fire = (F.when(user % 4 == 3, F.lit(None))
            .when(etype == "purchase", F.lit(1))
            .when((etype == "error") & (k >= 90), F.lit(2))
            .otherwise(F.lit(0))).cast("int")
    cols = {
        "Temperature (C)": temp,
        "Humidity (%)": F.lit(40.0) + F.col("event_id") % 37,
        "Pressure (hPA)": F.lit(1000.0) + user % 23,
        "Gas (Ohm)": gas,
        "Visible Light": null_d,
        "IR": null_d,
        "UV index": null_d,
        "CO": co,
        "NO2": value * k / 1000,
        "Smoke (ppm)": k / F.lit(1000.0),
        "Fire": fire,
        "node_id": F.concat(F.lit("nodo_"), (user % 4 + 1).cast("string")),
        "reading_index": F.col("event_id").cast("long"),
        "ingest_ts": F.col("ts"),
    }
    return events.select(*[c.cast("double").alias(n) if n in SENSOR_COLUMNS else c.alias(n)
                           for n, c in cols.items()], *keep)


def load_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings table for a test-data folder; NaN values are nulls (P10)."""
    return nan_to_null_all(readings_from_events(read_table(spark, table_path(sf_dir, "events"))), SENSOR_COLUMNS)
