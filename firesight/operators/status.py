"""Latest row, key state and node status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firesight.functions.columns import fire_state_label, is_fire, map_status, order_value, q, round_significant
from firesight.operators.enrich import ENRICH_COLUMNS
from firesight.spec import DEFAULT_SPEC, ROLLUP_SENSORS, SensorSpec

STATE_DECIMALS = 6
M2_DIGITS = 10


def _in_place(t: T.DataType) -> bool:
    """Types a hash aggregate can update in place."""
    return isinstance(t, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def latest_by_order(df: DataFrame, keys: list[str], order: Column, extra_aggs: dict[str, Column] | None = None) -> DataFrame:
    """Per key, the row with the greatest ``order`` (one number), in one pass. ``extra_aggs``: further aggregates
    over the same rows by their names.

    A ``max_by`` per column beside the other aggregates: every map task keeps
    one state per key, nothing is sorted and no row of the history is shuffled.
    All columns are taken by the same comparisons, so they come from one row.
    A ``max_by`` over text (or a whole-row struct) would run as a sort-based
    aggregate, so such columns travel in a join of the keys' top orders with
    the few rows that hold them instead.
    """
    others = [c for c in df.columns if c not in keys]
    flat = [c for c in others if _in_place(df.schema[c].dataType)]
    rest = [c for c in others if c not in flat]
    base = df.withColumn("_at", order)
    extra = extra_aggs or {}
    more = [a.alias(n) for n, a in extra.items()]
    aggs = [F.max_by(q(c), F.col("_at")).alias(c) for c in flat] + more
    if not rest:
        return base.groupBy(*keys).agg(*aggs, F.max("_at").alias("_at")).drop("_at").select(
            *keys, *[q(c) for c in others], *extra)
    top = base.groupBy(*[q(c).alias(f"_k{i}") for i, c in enumerate(keys)]).agg(
        F.max("_at").alias("_top"), *more)
    cond = F.col("_at") == F.col("_top")
    for i, c in enumerate(keys):
        cond = cond & q(c).eqNullSafe(F.col(f"_k{i}"))
    few = base.join(top, cond)
    # rows that tie on the whole order are few; the pick among them depends on their values only
    row = F.struct(*[q(c) for c in others], *extra)
    return (few.groupBy(*keys).agg(F.max_by(row, F.xxhash64(*[q(c) for c in others])).alias("_r"))
            .select(*keys, "_r.*"))


def latest_by_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ordering value (one or two
    integer columns, the first one counting most)."""
    at = F.col(order_cols[0]).cast("decimal(19,0)")
    if len(order_cols) == 2:
        at = at * F.expr("CAST('10000000000000000000' AS DECIMAL(20,0))") + F.col(order_cols[1]).cast("decimal(19,0)")
    elif len(order_cols) > 2:
        raise ValueError("at most two ordering columns")
    return latest_by_order(df, keys, at.cast("decimal(38,0)"))


def latest_rows(df: DataFrame, key: str = "node_id", extra_aggs: dict[str, Column] | None = None) -> DataFrame:
    """Each key's row with the greatest order (null index as 0; ties by
    ingest_ts), plus any ``extra_aggs`` over the same rows, from one scan."""
    return latest_by_order(df, [key], order_value(df), extra_aggs)


def latest_reading(df: DataFrame) -> DataFrame:
    """Each node's row with the greatest index (null index counts as 0)."""
    return latest_rows(df).select(*df.columns)


def coords_table(spark: SparkSession, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """J4 dimension: node -> (lat, lon). A fixed list from the spec."""
    schema = T.StructType([
        T.StructField("node_id", T.StringType(), False),
        T.StructField("lat", T.DoubleType(), True),
        T.StructField("lon", T.DoubleType(), True),
    ])
    rows = [(k, float(v[0]), float(v[1])) for k, v in sorted(spec.node_coords.items())]
    return spark.createDataFrame(rows, schema)


def node_state(clean_readings: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """The per-node running state after the whole history: count, mean and
    M2 of every scored sensor, and the last non-null Fire value."""
    aggs = []
    for col, name, _ in spec.scored:
        x = q(col)
        aggs += [
            F.count(x).alias(f"{name}_count"),
            F.round(F.avg(x), STATE_DECIMALS).alias(f"{name}_mean"),
            round_significant(F.var_pop(x) * F.count(x), M2_DIGITS).alias(f"{name}_m2"),
        ]
    fire = F.col("Fire")
    aggs.append(F.max_by(fire, F.when(fire.isNotNull(), order_value(clean_readings))).alias("last_fire_value"))
    return clean_readings.groupBy("node_id").agg(*aggs)


# The status table's columns, in order.
STATUS_COLUMNS = (
    "node_id", "last_ingest_ts", "temperature_c", "humidity_pct", "pressure_hpa", "gas_ohm",
    "co", "smoke_ppm", "fire", "is_fire", "fire_state_label", "is_anomaly_current",
    "anomaly_sensors", "zscore_Temperature", "zscore_CO", "zscore_Smoke", "zscore_Gas",
    "running_min_temp", "running_max_temp", "running_min_co", "running_max_co",
    "running_min_smoke", "running_max_smoke", "running_min_gas", "running_max_gas",
    "total_processed", "last_update_ts", "lat", "lon", "map_status",
)


def _running_totals() -> dict[str, Column]:
    totals = {"total_processed": F.count(F.lit(1))}
    for col, suf, d, *_ in ROLLUP_SENSORS:
        totals[f"running_min_{suf}"] = F.round(F.min(q(col)), d)
        totals[f"running_max_{suf}"] = F.round(F.max(q(col)), d)
    return totals


def status_row(latest: DataFrame, coords: DataFrame) -> DataFrame:
    """Status columns from a frame holding each node's latest reading (raw
    names), its z-scores, flags and the running totals."""
    fire = F.col("Fire")
    out = latest.select(
        "node_id",
        F.col("ingest_ts").alias("last_ingest_ts"),
        q("Temperature (C)").alias("temperature_c"),
        q("Humidity (%)").alias("humidity_pct"),
        q("Pressure (hPA)").alias("pressure_hpa"),
        q("Gas (Ohm)").alias("gas_ohm"),
        q("CO").alias("co"),
        q("Smoke (ppm)").alias("smoke_ppm"),
        fire.alias("fire"),
        is_fire(fire).alias("is_fire"),
        fire_state_label(fire).alias("fire_state_label"),
        F.col("is_anomaly").alias("is_anomaly_current"),
        "anomaly_sensors",
        *[F.col(c) if c in latest.columns else F.lit(None).cast("double").alias(c)  # a sensor that the spec doesn't score
          for c in STATUS_COLUMNS if c.startswith("zscore_")],
        *[c for c in latest.columns if c.startswith("running_") or c == "total_processed"],
        F.col("ingest_ts").alias("last_update_ts"),
        map_status(fire, F.col("is_anomaly")).alias("map_status"),
    )
    return out.join(F.broadcast(coords), "node_id", "left").select(*STATUS_COLUMNS)


def node_status(history: DataFrame, coords: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """One live row per node from the cleaned readings, from hash
    aggregates only (no sort of any node's history).

    A node's latest reading is the last in its order, so the running
    statistics it is scored against are the node's statistics over the whole
    history: its z-scores are (x - mean) / sqrt(M2 / (n - 1)) with count,
    mean and M2 of all non-null values. These, the running min/max and the
    totals come from the same hash aggregate that picks each node's latest
    row column by column (``latest_rows``): one scan, one shuffle of one state
    per node and task. ``coords`` is the fixed node dimension (broadcast: one
    row per configured node).
    """
    from firesight.operators.enrich import _flags, _zscore
    aggs = _running_totals()
    for col, name, _ in spec.scored:
        x = q(col)
        aggs |= {f"_n_{name}": F.count(x), f"_mean_{name}": F.avg(x), f"_m2_{name}": F.var_pop(x) * F.count(x),
                 f"_spread_{name}": F.min(x) < F.max(x)}
    latest = latest_rows(history, "node_id", aggs)
    latest = latest.withColumns({
        f"zscore_{name}": _zscore(q(col), F.col(f"_n_{name}"), F.col(f"_mean_{name}"), F.col(f"_m2_{name}"),
                                  F.col(f"_spread_{name}"), spec.z_decimals)
        for col, name, _ in spec.scored})
    anomalous, joined = _flags(spec)
    latest = latest.withColumns({"is_anomaly": anomalous, "anomaly_sensors": joined})
    return status_row(latest, coords)


def node_status_from_enriched(enriched: DataFrame, coords: DataFrame) -> DataFrame:
    """W6 from an enriched table (the streaming sink's form): latest enriched
    row per node joined with the running totals of the same rows."""
    latest = latest_reading(enriched).join(enriched.groupBy("node_id").agg(*[a.alias(n) for n, a in _running_totals().items()]), "node_id", "left")
    return status_row(latest, coords)


__all__ = ["latest_by_key", "latest_reading", "coords_table", "node_state", "node_status",
           "node_status_from_enriched", "ENRICH_COLUMNS"]
