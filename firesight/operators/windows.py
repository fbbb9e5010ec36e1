"""Tumbling event-time window aggregate (T1), shared by batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firesight.functions.columns import event_time, exact_avg, q
from firesight.spec import ROLLUP_SENSORS, WINDOW_DURATION

# The window table's columns, in order.
WINDOW_COLUMNS = ("window_start", "window_end", "node_id",
                  *(c for _, suf, _, _, most in ROLLUP_SENSORS for c in (f"avg_{suf}", f"{most}_{suf}")), "reading_count")


def window_aggs() -> list:
    aggs = []
    for col, suf, d, _, most in ROLLUP_SENSORS:
        extreme = F.max(q(col)) if most == "max" else F.min(q(col))
        aggs += [exact_avg(q(col), d).alias(f"avg_{suf}"), F.round(extreme, d).alias(f"{most}_{suf}")]
    return [*aggs, F.count(F.lit(1)).alias("reading_count")]


def with_event_ts(df: DataFrame) -> DataFrame:
    return df.withColumn("event_ts", event_time(df))


def window_stats(raw: DataFrame, duration: str = WINDOW_DURATION) -> DataFrame:
    """T1 (batch form): per (node, tumbling window) sensor stats on raw rows.

    Rows without an event time are dropped; ``reading_count`` counts every
    row, also those with null sensors. The streaming form adds a watermark
    (see streaming.jobs) and otherwise uses the same expressions.
    """
    ev = with_event_ts(raw).filter(F.col("event_ts").isNotNull())
    return flatten_window(ev.groupBy(F.window("event_ts", duration), F.col("node_id")).agg(*window_aggs()))


def flatten_window(df: DataFrame) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"),
                     *[c for c in WINDOW_COLUMNS[2:]])
