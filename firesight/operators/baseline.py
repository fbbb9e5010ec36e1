"""Batch baseline over the full raw history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firesight.functions.columns import event_time, exact_avg, q
from firesight.operators.quantiles import LEAF, exact_quantiles
from firesight.spec import DEFAULT_SPEC, SensorSpec

STAT_DECIMALS = 4


def with_event_time(df: DataFrame, col: str = "ingest_ts") -> DataFrame:
    """Event time as a timestamp column ``_ts`` (ISO text is parsed, junk -> null)."""
    return df.withColumn("_ts", event_time(df, col))


def _summary_aggs(spec: SensorSpec) -> list:
    aggs = [
        F.count(F.lit(1)).alias("total_readings"),
        F.min("_ts").alias("first_ingest_ts"),
        F.max("_ts").alias("last_ingest_ts"),
    ]
    for col, _, suf in spec.scored:
        x = q(col)
        aggs += [
            exact_avg(x, STAT_DECIMALS).alias(f"avg_{suf}"),
            F.round(F.min(x), STAT_DECIMALS).alias(f"min_{suf}"),
            F.round(F.max(x), STAT_DECIMALS).alias(f"max_{suf}"),
        ]
    return aggs


def _percentile_aggs(spec: SensorSpec) -> list:
    aggs = []
    points = list(spec.percentiles)
    names = [f"p{int(round(p * 100))}" for p in points]
    for col, _, suf in spec.scored:
        pct = F.percentile_approx(q(col), points, spec.percentile_accuracy)
        aggs += [F.round(pct.getItem(i), STAT_DECIMALS).alias(f"{n}_{suf}") for i, n in enumerate(names)]
    return aggs


def distinct_index_counts(raw: DataFrame) -> DataFrame:
    """Distinct reading indexes per node, as its own aggregate.

    Kept apart on purpose: a distinct aggregate makes Spark pre-aggregate
    every other function per (node, index), which would build one percentile
    sketch per reading. Alone it shuffles two narrow columns.
    """
    return raw.groupBy("node_id").agg(F.count_distinct(F.col("reading_index")).alias("distinct_reading_index"))


def _with_distinct(per_node: DataFrame, raw: DataFrame) -> DataFrame:
    out = per_node.join(distinct_index_counts(raw), "node_id", "left")
    cols = per_node.columns
    return out.select(cols[0], cols[1], "distinct_reading_index", *cols[2:])


def baseline_summary(raw: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """A3: counts, first/last time and avg/min/max per sensor, per node."""
    return _with_distinct(with_event_time(raw).groupBy("node_id").agg(*_summary_aggs(spec)), raw)


def baseline_percentiles(raw: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """A4: p50/p95/p99 per sensor and node, all points from one sketch per sensor."""
    return raw.groupBy("node_id").agg(*_percentile_aggs(spec))


def baseline_percentiles_exact(raw: DataFrame, spec: SensorSpec = DEFAULT_SPEC, leaf: int = LEAF) -> DataFrame:
    """A4, exact: the columns of ``baseline_percentiles`` by histogram refinement (``operators/quantiles.py``)."""
    points = list(spec.percentiles)
    found = exact_quantiles(raw, "node_id", [col for col, *_ in spec.scored], points, leaf)
    wide = [F.max(F.when((F.col("s") == s) & (F.col("i") == i), F.round("x", STAT_DECIMALS)))
            .alias(f"p{int(round(p * 100))}_{suf}") for s, (_, _, suf) in enumerate(spec.scored) for i, p in enumerate(points)]
    # a node without any value has its row too
    nodes = raw.select("node_id").distinct().select(F.col("node_id").alias("k"), F.lit(-1).alias("s"), F.lit(-1).alias("i"),
                                                    F.lit(None).cast("double").alias("x"))
    return found.unionByName(nodes).groupBy(F.col("k").alias("node_id")).agg(*wide)


def baseline(raw: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """A3 + A4: one aggregate (one shuffle of partial states) plus the distinct count."""
    per_node = with_event_time(raw).groupBy("node_id").agg(*_summary_aggs(spec), *_percentile_aggs(spec))
    return _with_distinct(per_node, raw)


def hourly_trend(raw: DataFrame) -> DataFrame:
    """A5: average temperature per (node, hour of day); rows without an hour dropped."""
    return (with_event_time(raw)
            .withColumn("hour", F.hour("_ts"))
            .filter(F.col("hour").isNotNull())
            .groupBy("node_id", "hour")
            .agg(exact_avg(q("Temperature (C)"), STAT_DECIMALS).alias("avg_temp")))


def hourly_trend_nested(raw: DataFrame) -> DataFrame:
    """The trend as one sorted ``array<struct<hour, avg_temp>>`` per node.

    At most 24 elements per node, so the collected list is bounded.
    """
    return (hourly_trend(raw)
            .groupBy("node_id")
            .agg(F.sort_array(F.collect_list(F.struct("hour", "avg_temp"))).alias("trend_hourly")))


def trend_text(trend) -> Column:
    """The nested trend as JSON text."""
    def cell(x):
        value = F.coalesce(x["avg_temp"].cast("string"), F.lit("null"))
        return F.concat(F.lit('{"hour":'), x["hour"].cast("string"), F.lit(',"avg_temp":'), value, F.lit("}"))
    return F.concat(F.lit("["), F.array_join(F.transform(trend, cell), ","), F.lit("]"))


def _quality_aggs(spec: SensorSpec) -> tuple[list, list]:
    """Confusion-matrix counts over cleaned, labelled rows, as masked counts
    inside the per-node aggregate; returns (aggregates, output columns)."""
    from firesight.functions.columns import fire_rule, outlier_condition
    from firesight.operators.quality import metric_columns
    labelled = outlier_condition(spec) & F.col("Fire").isNotNull()
    actual, pred = F.col("Fire") >= 1, fire_rule(spec)
    aggs = [F.count_if(labelled).alias("_labelled"),
            F.count_if(labelled & actual & pred).alias("tp"),
            F.count_if(labelled & ~actual & pred).alias("fp"),
            F.count_if(labelled & ~actual & ~pred).alias("tn"),
            F.count_if(labelled & actual & ~pred).alias("fn")]
    # a node without labelled rows gets null metrics (left join semantics)
    has = F.col("_labelled") > 0
    cols = [F.when(has, col).alias(f"val_{name}") for name, col in metric_columns()]
    return aggs, cols


def _pair_aggs(spec: SensorSpec) -> list:
    """The key correlation pairs per node, listwise deletion as input masks."""
    from firesight.operators.correlate import complete_condition, pearson
    ok = complete_condition(spec.corr_sensors)
    return [pearson(F.when(ok, q(a)), F.when(ok, q(b))).alias(label) for label, a, b in spec.corr_pairs]


def baseline_report(raw: DataFrame, spec: SensorSpec = DEFAULT_SPEC,
                    nested: bool = True, generated_at=None) -> DataFrame:
    """One row per node: baseline, hourly trend, detection quality and
    the key correlation pairs.

    One per-node aggregate computes the baseline, the percentiles, the
    detection counts (masked to cleaned, labelled rows) and the correlation
    pairs (masked to complete rows); the distinct-index count and the
    (node, hour) trend are two narrow aggregates; all are joined on node_id.
    Nothing is collected. The cleaned rows are those under the outlier mask.
    """
    q_aggs, q_cols = _quality_aggs(spec)
    per_node = (with_event_time(raw).groupBy("node_id")
                .agg(*_summary_aggs(spec), *_percentile_aggs(spec), *q_aggs, *_pair_aggs(spec)))
    base_cols = [c for c in per_node.columns if c not in ("_labelled", "tp", "fp", "tn", "fn")
                 and not c.startswith("corr_")]
    report = _with_distinct(per_node.select(*base_cols, *q_cols, *[label for label, _, _ in spec.corr_pairs]),
                            raw)
    if nested:
        trend = hourly_trend_nested(raw)
        report = report.join(trend, "node_id", "left").withColumn(
            "trend_hourly",
            F.coalesce(F.col("trend_hourly"),
                       F.array().cast("array<struct<hour:int,avg_temp:double>>")))
    if generated_at is not None:
        report = report.withColumn("report_generated_at", F.lit(generated_at))
    return report
