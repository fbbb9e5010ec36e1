"""Dashboard serving queries.

Every relative time range is anchored at ``as_of``: by default the latest
event time in the table, taken as a scalar subquery so nothing is collected
on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firesight.functions.columns import band, exact_avg, fire_card, q
from firesight.spec import HISTOGRAM_BUCKET, LATEST_ANOMALIES, SEVERITY_STEPS, TOP_NODES


def latest_time(df: DataFrame, col: str = "ingest_ts") -> Column:
    """Scalar subquery: max(col) of df (evaluated once, inside the plan)."""
    return df.select(F.max(col)).scalar()


def in_range(df: DataFrame, span: str, as_of: Column | None = None, col: str = "ingest_ts") -> DataFrame:
    """Rows whose time lies in (as_of - span, as_of]."""
    end = latest_time(df, col) if as_of is None else as_of
    return df.filter((F.col(col) > end - F.expr(f"INTERVAL {span}")) & (F.col(col) <= end))


def bucket(ts: Column, every: str) -> Column:
    return F.window(ts, every).start


# A12 --------------------------------------------------------------------------
def sensor_histogram(enriched: DataFrame, every: str = HISTOGRAM_BUCKET) -> DataFrame:
    """Average of each plotted sensor per (node, time bucket); empty buckets
    omitted. Averages are exact and shown to 9 decimals, so they do not
    depend on how the rows of a bucket were split across tasks."""
    return (enriched.groupBy("node_id", bucket(F.col("ingest_ts"), every).alias("bucket_start"))
            .agg(exact_avg(q("Temperature (C)"), 9).alias("avg_temp"),
                 exact_avg(q("CO"), 9).alias("avg_co"),
                 exact_avg(q("Smoke (ppm)"), 9).alias("avg_smoke"),
                 exact_avg(q("Gas (Ohm)"), 9).alias("avg_gas")))


# L2 ---------------------------------------------------------------------------
def topk_nodes(series: DataFrame, k: int = TOP_NODES, descending: bool = True) -> DataFrame:
    """Keep the series of the first k nodes by key (terms bucket, order by key).

    The node list is a grouped aggregate (one row per node) cut to k rows,
    then a left-semi join; the k-row side is broadcast because k bounds it.
    """
    order = F.col("node_id").desc() if descending else F.col("node_id").asc()
    nodes = series.select("node_id").distinct().orderBy(order).limit(k)
    return series.join(F.broadcast(nodes), "node_id", "left_semi")


# A13 --------------------------------------------------------------------------
def anomaly_count(enriched: DataFrame, span: str = "15 minutes", every: str = "1 minute",
                  as_of: Column | None = None) -> DataFrame:
    """Anomalous rows in the last ``span``: bucketed counts, then their sum.

    ``as_of`` defaults to the newest row of ``enriched``; pass a cheaper
    equivalent (e.g. the newest cleaned reading) to avoid a second pass."""
    end = latest_time(enriched) if as_of is None else as_of
    recent = in_range(enriched.filter(F.col("is_anomaly")), span, end)
    per_bucket = recent.groupBy(bucket(F.col("ingest_ts"), every).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return per_bucket.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("anomaly_count"))


# A14 / J6 ---------------------------------------------------------------------
#: Buckets per row of the spine before it is exploded: no row holds a longer array.
SPINE_SEGMENT = 4096


def fire_activity(enriched: DataFrame, every: str = "1 hour", start: Column | None = None,
                  end: Column | None = None) -> DataFrame:
    """Count of fire rows per (node, bucket), zero-filled over a time range.

    ``start`` and ``end`` (timestamps) bound the range, as a dashboard's time
    picker does; by default it is the table's own range, a scalar subquery over
    the counts. One aggregate over the readings gives the count of every
    occupied (node, bucket). The range's buckets are made in segments of
    SPINE_SEGMENT, so no row carries the whole range and no window gathers the
    nodes, and left-joined to the counts. Spine size = nodes x buckets in the range.
    """
    step = F.expr(f"INTERVAL {every}")
    at = F.col("ingest_ts")
    rows = enriched
    if start is not None:
        rows = rows.filter(at >= start)
    if end is not None:
        rows = rows.filter(at <= end)
    counts = (rows.groupBy("node_id", bucket(at, every).alias("bucket_start"))
              .agg(F.count_if(F.col("is_fire")).alias("fire_count")))
    seconds = int(enriched.sparkSession.range(1).select(
        F.unix_micros((F.lit("1970-01-01").cast("timestamp") + step).cast("timestamp"))).first()[0]) // 1_000_000
    own = counts.select(F.struct(F.min("bucket_start").alias("a"), F.max("bucket_start").alias("b"))).scalar()
    nodes = enriched.select("node_id").distinct().select("node_id", own.alias("_r")).select(
        "node_id", (F.col("_r.a") if start is None else _floor(start, every)).alias("_a"),
        (F.col("_r.b") if end is None else _floor(end, every)).alias("_b"))
    total = F.floor((_epoch(F.col("_b")) - _epoch(F.col("_a"))) / seconds)
    segments = nodes.select("node_id", "_a", total.alias("_n")).filter("_n is not null").select(
        "node_id", "_a", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_n") / SPINE_SEGMENT))).alias("_s"))
    spine = segments.select("node_id", "_a", F.explode(F.sequence(
        F.col("_s") * SPINE_SEGMENT, F.least(F.col("_n"), (F.col("_s") + 1) * SPINE_SEGMENT - 1))).alias("_i")).select(
        "node_id", F.timestamp_add("SECOND", F.col("_i") * seconds, F.col("_a")).alias("bucket_start"))
    return (spine.join(counts, ["node_id", "bucket_start"], "left")
            .select("node_id", "bucket_start", F.coalesce("fire_count", F.lit(0)).alias("fire_count")))


def _epoch(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / 1_000_000)


def _floor(ts: Column, every: str) -> Column:
    return F.window(ts, every).start


# A15 --------------------------------------------------------------------------
def window_reagg(windows: DataFrame, every: str = "1 hour") -> DataFrame:
    """Re-aggregate the window table: avg of the window averages per (node, bucket).

    The mean is exact before it is rounded (no tie flips from summation order).
    """
    return (windows.groupBy("node_id", bucket(F.col("window_start"), every).alias("bucket_start"))
            .agg(exact_avg(F.col("avg_temp"), 4).alias("avg_avg_temp")))


# L1 ---------------------------------------------------------------------------
def latest_anomalies(enriched: DataFrame, n: int = LATEST_ANOMALIES) -> DataFrame:
    """The n most recent anomalous rows (each task keeps its own top n)."""
    return (enriched.filter(F.col("is_anomaly"))
            .orderBy(F.col("ingest_ts").desc(), F.col("node_id"), F.col("reading_index").desc())
            .limit(n))


# L4 / P14 ---------------------------------------------------------------------
def node_card(status: DataFrame, node: str) -> DataFrame:
    """Point lookup of one node's status row, with its fire card text."""
    return (status.filter(F.col("node_id") == node).limit(1)
            .select("node_id", "is_fire", fire_card(F.col("is_fire")).alias("card"), "last_update_ts"))


def fire_cards(status: DataFrame) -> DataFrame:
    return status.select("node_id", "is_fire", fire_card(F.col("is_fire")).alias("card"))


# P12 --------------------------------------------------------------------------
MAP_PANEL_FIELDS = ("node_id", "fire_state_label", "map_status", "temperature_c", "humidity_pct", "co",
                    "smoke_ppm", "gas_ohm", "lat", "lon")


def panel_projection(df: DataFrame, fields: Sequence[str] = MAP_PANEL_FIELDS,
                     rename: dict | None = None) -> DataFrame:
    """Field subset, order and renames of a dashboard table panel."""
    rename = rename or {}
    return df.select(*[F.col(f).alias(rename.get(f, f)) for f in fields])


BASELINE_PANEL_FIELDS = ("node_id", "p50_temp", "p95_temp", "p99_temp", "avg_temp", "p50_co", "p95_co", "p99_co",
                         "avg_co", "p50_smoke", "p95_smoke", "p99_smoke", "avg_smoke", "p50_gas", "p95_gas",
                         "p99_gas", "avg_gas")


# Titles of the report panels, as the dashboards show them.
SENSOR_TITLES = {"temp": "Temp", "co": "CO", "smoke": "Smoke", "gas": "Gas"}
STAT_TITLES = {"p50": "p50", "p95": "p95", "p99": "p99", "avg": "media"}
BASELINE_PANEL_TITLES = {"node_id": "Nodo", **{f"{stat}_{s}": f"{title} {name}" for s, title in SENSOR_TITLES.items()
                                               for stat, name in STAT_TITLES.items()}}
COVERAGE_PANEL_TITLES = {"node_id": "Nodo", "total_readings": "Letture totali",
                         "distinct_reading_index": "reading_index distinti", "first_ingest_ts": "Primo ingest",
                         "last_ingest_ts": "Ultimo ingest"}
QUALITY_PANEL_TITLES = {"node_id": "Nodo", "val_tp": "TP", "val_fp": "FP", "val_tn": "TN", "val_fn": "FN",
                        "val_precision": "Precision", "val_recall": "Recall", "val_f1": "F1", "val_accuracy": "Accuracy"}


def titled_panel(report: DataFrame, titles: dict) -> DataFrame:
    """A panel's fields in its order, under its titles, sorted by node."""
    return panel_projection(report.orderBy("node_id"), tuple(titles), titles)


def sorted_panel(report: DataFrame, fields: Sequence[str] = BASELINE_PANEL_FIELDS) -> DataFrame:
    """L3: a report table panel: field subset in panel order, sorted by node."""
    return panel_projection(report, fields).orderBy("node_id")


# P13 --------------------------------------------------------------------------
def severity_bands(readings: DataFrame) -> DataFrame:
    """Band index of every plotted value (0 = below the first step)."""
    return readings.select(
        "node_id", "reading_index",
        band(q("Temperature (C)"), SEVERITY_STEPS["temperature_c"]).alias("temp_band"),
        band(q("CO"), SEVERITY_STEPS["co"]).alias("co_band"),
        band(q("Smoke (ppm)"), SEVERITY_STEPS["smoke_ppm"]).alias("smoke_band"),
        band(q("Gas (Ohm)"), SEVERITY_STEPS["gas_ohm"]).alias("gas_band"),
    )


def report_bands(report: DataFrame, pairs: Sequence[str]) -> DataFrame:
    """Bands of a report's tail temperature, detection metrics and correlation pairs."""
    metrics = ("val_precision", "val_recall", "val_f1", "val_accuracy")
    return report.select("node_id", band(F.col("p99_temp"), SEVERITY_STEPS["p99_temp"]).alias("p99_temp_band"),
                         *[band(F.col(c), SEVERITY_STEPS["metric"]).alias(f"{c}_band") for c in metrics],
                         *[band(F.col(c), SEVERITY_STEPS["correlation"]).alias(f"{c}_band") for c in pairs])


def status_bands(status: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Map marker band of every node beside the band of the recent anomaly count (one row)."""
    n = anomalies.select("anomaly_count").scalar()
    return status.select("node_id", band(F.col("map_status"), SEVERITY_STEPS["map_status"]).alias("map_band"),
                         band(n, SEVERITY_STEPS["anomaly_count"]).alias("anomaly_count_band"))


# P15 --------------------------------------------------------------------------
def node_fire_rows(enriched: DataFrame, node: str) -> DataFrame:
    """Rows of one node with the fire flag set (term AND term)."""
    return (enriched.filter((F.col("node_id") == node) & F.col("is_fire"))
            .select("node_id", "reading_index", "ingest_ts", "Fire"))
