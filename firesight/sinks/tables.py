"""Sinks and table maintenance (S7-S14). The keyed, merged-on-read tables are in ``sinks/keyed.py``."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firesight.functions.columns import nan_to_null, q
from firesight.operators.status import latest_by_key
from firesight.sinks.keyed import (BATCH, EVERY, batches_of, compact, delete, maintain, move, names,  # noqa: F401
                                   read_batches, read_upserted, store, write_batch)
from firesight.spec import DEFAULT_SPEC, SENSOR_COLUMNS, SensorSpec

log = logging.getLogger(__name__)


# S7 ---------------------------------------------------------------------------
def upsert_latest(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Pure form of the upsert: last write per key wins."""
    return latest_by_key(df, list(keys), list(order_cols))


# S8 / S9 ----------------------------------------------------------------------
def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace the snapshot at ``path`` with ``df``.

    The rows are written beside it first (a name that readers of the parent folder skip) and moved into place when
    they are complete, so that a failure while writing leaves the old snapshot as it was and nobody sees a half one.
    """
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    mark = uuid.uuid4().hex[:12]
    new, old = f"{parent}/.{name}-{mark}-new", f"{parent}/.{name}-{mark}-old"
    df.write.parquet(new)
    if name in names(spark, parent):
        move(spark, path, old)
    move(spark, new, path)
    delete(spark, old)


def write_mirror(df: DataFrame, path: str, fmt: str = "json") -> bool:
    """Best-effort second copy; a failure is logged, never raised."""
    try:
        df.write.mode("overwrite").format(fmt).save(path)
        return True
    except Exception as exc:  # the mirror must not fail the job
        log.warning("mirror write to %s failed: %s", path, exc)
        return False


# S10 --------------------------------------------------------------------------
def to_serving(enriched: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Snake_case names, NaN as missing, typed flags."""
    cols = []
    for c in enriched.columns:
        name = spec.serving_names.get(c, c)
        col = q(c)
        if c in SENSOR_COLUMNS:
            col = nan_to_null(col)
        elif c == "Fire":
            col = col.cast("int")
        elif c in ("is_anomaly", "is_fire"):
            col = F.coalesce(col.cast("boolean"), F.lit(False))
        cols.append(col.alias(name))
    return enriched.select(*cols)


# S11 --------------------------------------------------------------------------
def apply_retention(df: DataFrame, period: str, as_of=None, ts_col: str = "ingest_ts") -> DataFrame:
    """Keep rows newer than ``as_of - period`` (as_of defaults to the newest row).

    On a table partitioned by date the filter prunes whole files.
    """
    end = df.select(F.max(ts_col)).scalar() if as_of is None else as_of
    return df.filter(F.col(ts_col) >= end - F.expr(f"INTERVAL {period}"))


DATE = "date"


def write_dated(df: DataFrame, path: str, ts_col: str = "ingest_ts") -> None:
    """Append to a table partitioned by the date of ``ts_col``, so that old days can go as folders."""
    dated = df.withColumn(DATE, F.to_date(ts_col))
    dated.hint("rebalance", DATE).write.mode("append").partitionBy(DATE).parquet(path)


def read_retained(spark: SparkSession, path: str, period: str, as_of, ts_col: str = "ingest_ts") -> DataFrame:
    """The rows of a dated table within ``period`` before ``as_of`` (a datetime): only the days inside are read."""
    start = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {period}")
    rows = spark.read.parquet(path)
    return rows.filter((F.col(DATE) >= F.to_date(start)) & (F.col(ts_col) >= start)).drop(DATE)


def purge(spark: SparkSession, path: str, period: str, as_of) -> list[str]:
    """Remove the days of a dated table that lie wholly before ``as_of - period``; returns them. Other days'
    files aren't touched. Rows without a time (the default partition) stay."""
    first = spark.range(1).select(F.to_date(F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {period}"))).first()[0]
    days = [n.partition("=")[2] for n in names(spark, path) if n.startswith(f"{DATE}=")]
    gone = sorted(d for d in days if re.fullmatch(r"\d{4}-\d\d-\d\d", d) and d < first.isoformat())
    for d in gone:
        delete(spark, f"{path}/{DATE}={d}")
    return gone


# S12 --------------------------------------------------------------------------
def dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop repeated keys (batch). Streams use ``dropDuplicatesWithinWatermark``."""
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


# S13 --------------------------------------------------------------------------
ALERT_FIELDS = ("node_id", "fire_value", "fire_value_prev", "ingest_ts", "temperature_c", "co", "smoke_ppm")


def alerts(events: DataFrame) -> DataFrame:
    """Alert payload per fire transition: typed columns plus the JSON document."""
    flat = events.select(
        "node_id", "reading_index", "fire_value", "fire_value_prev",
        F.date_format("ingest_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingest_ts"),
        "temperature_c", "co", "smoke_ppm")
    return flat.withColumn("payload", F.to_json(F.struct(*[F.col(c) for c in ALERT_FIELDS]),
                                                {"ignoreNullFields": "false"}))


# S14 --------------------------------------------------------------------------
def audit_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every named table, as one (table_name, row_count) frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stored_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """S14 over stored Parquet tables: (table_name, row_count) from the files' footers.

    The tables are opened by the scan that takes an aggregate with it (``PushedAggregation``): no row is read and
    nothing is computed again. ``paths``: the folder of each table.
    """
    v1, push = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"
    spark.conf.set(push, "true")
    old = spark.conf.get(v1)
    spark.conf.set(v1, ",".join(x for x in old.split(",") if x != "parquet"))
    try:
        return audit_counts({name: spark.read.parquet(path) for name, path in paths.items()})
    finally:
        spark.conf.set(v1, old)
