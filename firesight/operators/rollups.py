"""Per-node roll-ups.

The reference keeps cumulative statistics in an external document updated from
the driver after each micro-batch. Here a micro-batch is a value of a batch
column (the streaming batch id, or a time bucket of ``ingest_ts`` when a table
is replayed), and every roll-up is a partial aggregate keyed by node, so the
shuffle carries one state per node and map task whatever the node sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firesight.functions.columns import exact_avg, q
from firesight.spec import ROLLUP_SENSORS

def batch_bucket(ts: Column, every: str = "1 hour") -> Column:
    """Batch id of a replayed table: the start of the ``every`` bucket of ts."""
    return F.window(ts, every).start


def node_batch_stats(df: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """A1: per (node, batch): count and rounded avg/min/max/sum of 4 sensors."""
    aggs = [F.count(F.lit(1)).alias("batch_count")]
    for col, suf, d, ds, _ in ROLLUP_SENSORS:
        x = q(col)
        aggs += [
            exact_avg(x, d).alias(f"batch_avg_{suf}"),
            F.round(F.min(x), d).alias(f"batch_min_{suf}"),
            F.round(F.max(x), d).alias(f"batch_max_{suf}"),
            F.round(F.sum(x), ds).alias(f"batch_sum_{suf}"),
        ]
    return df.groupBy("node_id", batch_col).agg(*aggs)


def cumulative_stats(df: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """A2: one row per node: running count, sums, min and max over the whole
    history plus the averages of the node's last batch.

    Sums are exact and rounded on output (the reference adds rounded batch
    sums, which makes totals depend on how rows were batched).
    """
    per = [F.count(F.lit(1)).alias("_n"), F.max("ingest_ts").alias("_t")]
    totals = [F.sum("_n").alias("total_processed")]
    last = []
    for col, suf, d, ds, _ in ROLLUP_SENSORS:
        x = q(col)
        per += [F.sum(x).alias(f"_sum_{suf}"), F.min(x).alias(f"_min_{suf}"), F.max(x).alias(f"_max_{suf}"),
                exact_avg(x, d).alias(f"_avg_{suf}")]
        totals += [
            F.round(F.sum(f"_sum_{suf}"), ds).alias(f"running_sum_{suf}"),
            F.round(F.min(f"_min_{suf}"), d).alias(f"running_min_{suf}"),
            F.round(F.max(f"_max_{suf}"), d).alias(f"running_max_{suf}"),
        ]
        last.append(F.max_by(f"_avg_{suf}", batch_col).alias(f"last_batch_avg_{suf}"))
    totals.append(F.max("_t").alias("last_update"))
    # one scan: the history becomes one row per (node, batch), and these one row per node
    return df.groupBy("node_id", batch_col).agg(*per).groupBy("node_id").agg(*totals, *last)


def cumulative_by_batch(batch_stats: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """A2, per-batch view: running totals after each batch of each node.

    Runs over the A1 table (one row per node and batch), not over readings.
    """
    w = Window.partitionBy("node_id").orderBy(batch_col).rowsBetween(Window.unboundedPreceding, 0)
    cols = {"total_processed": F.sum("batch_count").over(w)}
    for _, suf, _, ds, _ in ROLLUP_SENSORS:
        cols[f"running_sum_{suf}"] = F.round(F.sum(f"batch_sum_{suf}").over(w), ds)
        cols[f"running_min_{suf}"] = F.min(f"batch_min_{suf}").over(w)
        cols[f"running_max_{suf}"] = F.max(f"batch_max_{suf}").over(w)
    return batch_stats.select("node_id", batch_col, *[c.alias(n) for n, c in cols.items()],
                              *[F.col(f"batch_avg_{suf}").alias(f"last_batch_avg_{suf}")
                                for _, suf, *_ in ROLLUP_SENSORS])


def enrichment_counts(enriched: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Rows, fire rows and anomaly rows per node and batch, plus the
    batch total over all nodes (a window over the small aggregate)."""
    per = (enriched.groupBy("node_id", batch_col)
           .agg(F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col("is_fire")).alias("fire_rows"),
                F.count_if(F.col("is_anomaly")).alias("anomaly_rows")))
    return per.withColumn("batch_rows", F.sum("rows").over(Window.partitionBy(batch_col)))


def snapshot_rollup(report: DataFrame) -> DataFrame:
    """Sum of totals and max of p99 temperature by node, all nodes in order."""
    return (report.groupBy("node_id")
            .agg(F.sum("total_readings").alias("sum_total_readings"),
                 F.max("p99_temp").alias("max_p99_temp"))
            .orderBy("node_id"))


def fire_distribution(raw: DataFrame) -> DataFrame:
    """Count of each Fire value per node."""
    return raw.groupBy("node_id", "Fire").agg(F.count(F.lit(1)).alias("n"))
