"""Ordered per-node operators (W1-W4, W8): running z-scores, anomaly flags and
fire-state transitions.

Each node's readings form one ordered sequence (by ``reading_index``, null as
0). A plain window ``partitionBy(node).orderBy(index)`` would put a node's whole
history into one task, and there are very few nodes. ``enrich`` therefore runs
a two-level prefix scan:

1. cut each node's sequence into chunks of ``chunk_rows`` consecutive index
   values and summarise every chunk (count, mean, M2, min, max per sensor; last
   non-null fire label in index and time order) - a partial aggregate, so the
   shuffle carries one row per chunk and map task;
2. over the small chunk table, compute for every chunk the summary of all
   earlier chunks of its node (exclusive running sums, shifted by a per-node
   reference to avoid cancellation);
3. run the running window only inside (node, chunk) and merge it with the
   carried-in prefix using the pairwise update of Chan, Golub and LeVeque
   (n = a+b, d = mean_b-mean_a, mean = mean_a + d*b/n, M2 = M2_a + M2_b + d^2*a*b/n).

Parallelism is nodes x chunks; the result equals the sequential Welford update
up to floating-point rounding. Min and max merge exactly, so a series that has
been flat so far scores exactly 0.0 whatever the rounding of its merged M2. ``method="window"`` keeps the plain one-level
window for comparison and tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firesight.functions.columns import _compare, clean, event_time, fire_state_label, is_fire, order_value, q
from firesight.operators.chunks import PART, PLACE, chunk_of, sorted_parts
from firesight.spec import DEFAULT_SPEC, SensorSpec

# Index values per chunk. With one reading per index a chunk is one sort task
# of about 50 MB at ~200 bytes a row; a node with 10^11 readings has ~4*10^5
# chunk-summary rows. Readings without an index all count as 0 and come first;
# they are cut by day (``chunk_key``). Readings that repeat another index add to
# their chunk.
DEFAULT_CHUNK_ROWS = 1 << 18

ORD = "_ord"
CHUNK = "_chunk"

FLAG_COLUMNS = ("is_anomaly", "anomaly_sensors", "is_fire", "is_fire_transition", "fire_value_prev", "fire_state_label")


def enrich_columns(spec: SensorSpec = DEFAULT_SPEC) -> tuple[str, ...]:
    """The columns that enrichment adds: a z-score per scored sensor, then flags and labels."""
    return (*(f"zscore_{name}" for _, name, _ in spec.scored), *FLAG_COLUMNS)


ENRICH_COLUMNS = enrich_columns()


def order_key(df: DataFrame) -> DataFrame:
    """The processing order of a node's readings (null index counts as 0)."""
    return df.withColumn(ORD, F.coalesce(F.col("reading_index").cast("long"), F.lit(0)))


_DAYS = 1 << 20


def chunk_key(df: DataFrame, chunk_rows: int) -> Column:
    """The chunk of a row (``df`` has ORD), never falling in the order of (index, time).

    ``chunk_rows`` consecutive index values make a chunk; those with index 0,
    where readings without an index gather, are cut by day ahead of the rest.
    """
    part = F.floor(F.col(ORD) / F.lit(int(chunk_rows))).cast("long") * F.lit(_DAYS)
    day = F.floor(F.unix_micros(event_time(df).cast("timestamp")) / F.lit(86_400_000_000)).cast("long") + F.lit(_DAYS // 2)
    day = F.coalesce(F.least(F.greatest(day, F.lit(1)), F.lit(_DAYS - 2)), F.lit(0))
    return F.when(F.col(ORD) == 0, day).otherwise(part + F.lit(_DAYS - 1))


def _zscore(x: Column, n: Column, mean: Column, m2: Column, spread: Column, decimals: int) -> Column:
    """Signed z of the current value against the running stats that include it.

    Sample variance m2/(n-1); n = 1 or zero spread gives 0.0; a null value
    gives null. ``spread`` says whether two values so far differ (min < max):
    a merged M2 may be a rounding error above zero where none do. ``+ 0.0``
    turns a rounded -0.0 into 0.0.
    """
    std = F.sqrt(m2 / (n - 1))
    z = F.round((x - mean) / std, decimals) + F.lit(0.0)
    return (F.when(x.isNull(), F.lit(None).cast("double"))
            .when((n > 1) & spread & (m2 > 0), z)
            .otherwise(F.lit(0.0)))


def _flags(spec: SensorSpec) -> tuple[Column, Column]:
    """(is_anomaly, anomaly_sensors): z-flags in sensor order, then threshold
    flags not already present. Plain ``when`` terms joined by ``concat_ws``
    (which skips nulls) keep this inside generated code - no arrays or lambdas."""
    z_hit = {name: F.abs(F.coalesce(F.col(f"zscore_{name}"), F.lit(0.0))) > F.lit(spec.z_threshold)
             for _, name, _ in spec.scored}
    terms, conds = [], []
    for _, name, _ in spec.scored:
        terms.append(F.when(z_hit[name], F.lit(name)))
        conds.append(z_hit[name])
    for name, col, op, thr in spec.thresholds:
        hit = F.coalesce(_compare(q(col), op, thr), F.lit(False))
        terms.append(F.when(hit & ~z_hit.get(name, F.lit(False)), F.lit(name)))
        conds.append(hit)
    anomalous = conds[0]
    for c in conds[1:]:
        anomalous = anomalous | c
    return anomalous, F.concat_ws(", ", *terms)


def finish(df: DataFrame, prev_fire: Column, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """W2 + W3 from the z-scores and the previous non-null fire value."""
    anomalous, joined = _flags(spec)
    fire = F.col("Fire")
    return (df.withColumn("_prev_fire", prev_fire)
            .withColumns({
                "is_anomaly": anomalous,
                "anomaly_sensors": joined,
                "is_fire": is_fire(fire),
                "is_fire_transition": F.coalesce(
                    (fire >= 1) & (F.col("_prev_fire").isNull() | (F.col("_prev_fire") == 0)),
                    F.lit(False)),
                "fire_value_prev": F.coalesce(F.col("_prev_fire"), F.lit(0)).cast("int"),
                "fire_state_label": fire_state_label(fire),
            })
            .drop("_prev_fire"))


def score_window(df: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """W1-W3 with one running window per node (one task per node)."""
    base = order_key(df)
    order = [F.col(ORD), F.col("ingest_ts")]
    w = Window.partitionBy("node_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    w_prev = Window.partitionBy("node_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zs = {}
    for col, name, _ in spec.scored:
        x = q(col)
        n = F.count(x).over(w)
        mean = F.avg(x).over(w)
        m2 = F.var_pop(x).over(w) * n
        zs[f"zscore_{name}"] = _zscore(x, n, mean, m2, F.min(x).over(w) < F.max(x).over(w), spec.z_decimals)
    scored = base.withColumns(zs)
    prev = F.last(F.col("Fire"), ignorenulls=True).over(w_prev)
    return finish(scored, prev, spec).drop(ORD)


def _chunk_summaries(base: DataFrame, spec: SensorSpec) -> DataFrame:
    """Step 1: one row per (node, chunk); a partial aggregate before the shuffle."""
    aggs = []
    for col, name, _ in spec.scored:
        x = q(col)
        aggs += [
            F.count(x).alias(f"_n_{name}"),
            F.avg(x).alias(f"_mean_{name}"),
            (F.var_pop(x) * F.count(x)).alias(f"_m2_{name}"),
            F.min(x).alias(f"_lo_{name}"),
            F.max(x).alias(f"_hi_{name}"),
        ]
    fire = F.col("Fire")
    aggs.append(F.max_by(fire, F.when(fire.isNotNull(), order_value(base))).alias("_last_fire"))
    return base.groupBy("node_id", CHUNK).agg(*aggs)


def _carry_in(chunks: DataFrame, spec: SensorSpec) -> DataFrame:
    """Step 2: for each chunk, the merged summary of all earlier chunks of its node.

    Two window passes over the small chunk table: a per-node reference mean
    (to shift the running sums and avoid cancellation), then exclusive running
    sums of n, n*d, n*d^2 and M2 over the earlier chunks.
    """
    node = Window.partitionBy("node_id")
    before = node.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    names = [name for _, name, _ in spec.scored]
    out = chunks.withColumns({f"_ref_{n}": F.avg(f"_mean_{n}").over(node) for n in names})
    sums = {"_cfire": F.last(F.col("_last_fire"), ignorenulls=True).over(before)}
    for n in names:
        cnt, m2 = F.col(f"_n_{n}"), F.coalesce(F.col(f"_m2_{n}"), F.lit(0.0))
        d = F.coalesce(F.col(f"_mean_{n}") - F.col(f"_ref_{n}"), F.lit(0.0))
        sums[f"_pn_{n}"] = F.coalesce(F.sum(cnt).over(before), F.lit(0))
        sums[f"_pd_{n}"] = F.coalesce(F.sum(cnt * d).over(before), F.lit(0.0))
        sums[f"_pdd_{n}"] = F.coalesce(F.sum(cnt * d * d).over(before), F.lit(0.0))
        sums[f"_pm2_{n}"] = F.coalesce(F.sum(m2).over(before), F.lit(0.0))
        sums[f"_clo_{n}"] = F.min(f"_lo_{n}").over(before)
        sums[f"_chi_{n}"] = F.max(f"_hi_{n}").over(before)
    out = out.withColumns(sums)
    cols = []
    for n in names:
        pn, pd, pdd, pm2 = (F.col(f"_pn_{n}"), F.col(f"_pd_{n}"), F.col(f"_pdd_{n}"), F.col(f"_pm2_{n}"))
        has = pn > 0
        cols += [
            pn.alias(f"_cn_{n}"),
            F.when(has, F.col(f"_ref_{n}") + pd / pn).otherwise(F.lit(0.0)).alias(f"_cmean_{n}"),
            F.when(has, F.greatest(pm2 + pdd - pd * pd / pn, F.lit(0.0))).otherwise(F.lit(0.0))
            .alias(f"_cm2_{n}"),
            f"_clo_{n}", f"_chi_{n}",
        ]
    return out.select("node_id", CHUNK, *cols, "_cfire")


def largest_chunk(df: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> int:
    """Rows of the largest chunk that cutting by index values gives: one narrow scan."""
    base = order_key(df)
    sizes = base.withColumn(CHUNK, chunk_key(base, chunk_rows)).groupBy("node_id", CHUNK).count()
    return sizes.agg(F.max("count")).first()[0] or 0


def by_rows(df: DataFrame, chunk_rows: int) -> DataFrame:
    """The readings in order with CHUNK, at most ``chunk_rows`` rows each (``operators/chunks.py``)."""
    stored = sorted_parts(order_key(df), "node_id", [ORD, "ingest_ts"])
    return stored.withColumn(CHUNK, chunk_of(chunk_rows)).drop(PART, PLACE)


def score_prefix(df: DataFrame, spec: SensorSpec = DEFAULT_SPEC,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS, cuts: str = "width") -> DataFrame:
    """W1-W3 by the two-level prefix scan (see module docstring).

    ``cuts``: "width" cuts a node's readings by index values, without any job; "rows" by their number, from
    a sorted copy, whatever indexes repeat; "auto" counts the rows of the first and takes the second if a
    chunk has more than twice ``chunk_rows``.
    """
    if cuts == "auto":
        cuts = "rows" if largest_chunk(df, chunk_rows) > 2 * chunk_rows else "width"
    if cuts == "rows":
        base = by_rows(df, chunk_rows)
    elif cuts == "width":
        base = order_key(df)
        base = base.withColumn(CHUNK, chunk_key(base, chunk_rows))
    else:
        raise ValueError(cuts)
    carry = _carry_in(_chunk_summaries(base, spec), spec)

    order = [F.col(ORD), F.col("ingest_ts")]
    part = Window.partitionBy("node_id", CHUNK).orderBy(*order)
    w = part.rowsBetween(Window.unboundedPreceding, 0)
    w_prev = part.rowsBetween(Window.unboundedPreceding, -1)
    local = {}
    for col, name, _ in spec.scored:
        x = q(col)
        local[f"_ln_{name}"] = F.count(x).over(w)
        local[f"_lmean_{name}"] = F.avg(x).over(w)
        local[f"_lm2_{name}"] = F.var_pop(x).over(w) * F.count(x).over(w)
        local[f"_llo_{name}"] = F.min(x).over(w)
        local[f"_lhi_{name}"] = F.max(x).over(w)
    local["_lfire"] = F.last(F.col("Fire"), ignorenulls=True).over(w_prev)
    windowed = base.withColumns(local)

    # The chunk table is tiny next to the readings; AQE turns this join into a
    # broadcast only once the measured size is under the threshold, otherwise
    # the readings side keeps its (node, chunk) partitioning from the window.
    joined = windowed.join(carry, ["node_id", CHUNK], "left")

    # Merge in stages of plain columns, so no large expression is inlined
    # several times into the next one (keeps the stage inside codegen).
    merged = {}
    for _, name, _ in spec.scored:
        cn = F.coalesce(F.col(f"_cn_{name}"), F.lit(0))
        merged[f"_n_{name}"] = cn + F.col(f"_ln_{name}")
        merged[f"_d_{name}"] = F.col(f"_lmean_{name}") - F.coalesce(F.col(f"_cmean_{name}"), F.lit(0.0))
    joined = joined.withColumns(merged)
    stats = {}
    for _, name, _ in spec.scored:
        cn = F.coalesce(F.col(f"_cn_{name}"), F.lit(0))
        ln, n, d = F.col(f"_ln_{name}"), F.col(f"_n_{name}"), F.col(f"_d_{name}")
        stats[f"_mean_{name}"] = F.coalesce(F.col(f"_cmean_{name}"), F.lit(0.0)) + d * ln / n
        stats[f"_m2_{name}"] = (F.coalesce(F.col(f"_cm2_{name}"), F.lit(0.0)) + F.col(f"_lm2_{name}")
                                + d * d * cn * ln / n)
    joined = joined.withColumns(stats)
    zs = {f"zscore_{name}": _zscore(q(col), F.col(f"_n_{name}"), F.col(f"_mean_{name}"),
                                    F.col(f"_m2_{name}"),
                                    F.least(f"_clo_{name}", f"_llo_{name}") < F.greatest(f"_chi_{name}", f"_lhi_{name}"),
                                    spec.z_decimals)
          for col, name, _ in spec.scored}
    scored = joined.withColumns(zs)
    prev = F.coalesce(F.col("_lfire"), F.col("_cfire"))
    out = finish(scored, prev, spec)
    return out.select(*df.columns, *enrich_columns(spec))


def score(df: DataFrame, spec: SensorSpec = DEFAULT_SPEC, method: str = "prefix",
          chunk_rows: int = DEFAULT_CHUNK_ROWS, cuts: str = "width") -> DataFrame:
    """W1-W3 on already-cleaned readings."""
    if method == "window":
        return score_window(df, spec).select(*df.columns, *enrich_columns(spec))
    if method == "prefix":
        return score_prefix(df, spec, chunk_rows, cuts)
    raise ValueError(method)


def enrich(readings: DataFrame, spec: SensorSpec = DEFAULT_SPEC, method: str = "prefix",
           chunk_rows: int = DEFAULT_CHUNK_ROWS, cuts: str = "width") -> DataFrame:
    """Enriched table: outlier filter (P1), then W1-W3."""
    return score(clean(readings, spec), spec, method, chunk_rows, cuts)


def fire_events(enriched: DataFrame) -> DataFrame:
    """Transition rows with their context columns."""
    return (enriched.filter(F.col("is_fire_transition"))
            .select(
                "node_id", "reading_index",
                F.col("Fire").alias("fire_value"),
                "fire_value_prev",
                F.col("ingest_ts"),
                q("Temperature (C)").alias("temperature_c"),
                q("CO").alias("co"),
                q("Smoke (ppm)").alias("smoke_ppm"),
            ))
