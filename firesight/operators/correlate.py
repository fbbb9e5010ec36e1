"""Pearson correlation between sensors, globally and per node.

One aggregate gives every node's mergeable state: rows, means, and co-moments of all pairs. The global
scope is these states merged (Chan, Golub, LeVeque; Pebay): with the global means M, the co-moment of a pair is
the sum of the nodes' co-moments and of n * (mean_a - M_a) * (mean_b - M_b). No row is read or
expanded twice, and the shuffle carries one state per node and map task. A sensor without spread (smallest
value equal to the largest, which merge exactly) has no correlation, whatever rounding its merged moments hold.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firesight.functions.columns import q
from firesight.spec import DEFAULT_SPEC, SHORT_NAMES, SensorSpec

CORR_DECIMALS = 4
GLOBAL = "global"
#: Parts in which node states meet for the global scope, so that no task gets all nodes.
MERGE_PARTS = 256


def pair_column(a: str, b: str) -> str:
    return f"corr_{SHORT_NAMES[a]}_{SHORT_NAMES[b]}"


def complete_condition(sensors) -> Column:
    """True when every sensor of the row is a number (listwise deletion)."""
    cond = None
    for s in sensors:
        c = q(s).isNotNull() & ~F.isnan(q(s))
        cond = c if cond is None else (cond & c)
    return cond


def complete_rows(df: DataFrame, sensors) -> DataFrame:
    """Listwise deletion: keep rows where every sensor is a number."""
    return df.filter(complete_condition(sensors))


def node_moments(raw: DataFrame, sensors) -> DataFrame:
    """Per node: ``n`` complete rows and, by the sensors' places, means ``m0``.., smallest and largest values
    ``lo0``.., ``hi0``.., and (co)variances ``c0_0``, ``c0_1``.."""
    k = len(sensors)
    # inline keeps computed sensor columns from being computed anew in every condition and aggregate
    rows = raw.select("node_id", *[q(s) for s in sensors]).selectExpr(
        "inline(array(struct(node_id, " + ", ".join(f"`{s}` AS x{i}" for i, s in enumerate(sensors)) + ")))")
    rows = complete_rows(rows, [f"x{i}" for i in range(k)])
    aggs = ["count(1) AS n"]
    for i in range(k):
        aggs += [f"avg(x{i}) AS m{i}", f"min(x{i}) AS lo{i}", f"max(x{i}) AS hi{i}", f"var_pop(x{i}) AS c{i}_{i}"]
        aggs += [f"covar_pop(x{i}, x{j}) AS c{i}_{j}" for j in range(i + 1, k)]
    return rows.groupBy("node_id").agg(*map(F.expr, aggs))


def pair_moments(nodes: DataFrame, k: int) -> DataFrame:
    """The states of ``node_moments`` in long form, a row per pair (``i``, ``j``) of the ``k`` sensors, i <= j: means ``a``
    and ``b``, co-moment ``c`` (a sum of products of deviations), and ``flat``: one of the sensors has no spread (its
    smallest and largest values ``lo_a``.. decide)."""
    cells = ", ".join(f"struct({i} AS i, {j} AS j, m{i} AS a, m{j} AS b, c{i}_{j} * n AS c, lo{i} AS lo_a, hi{i} AS hi_a, "
                      f"lo{j} AS lo_b, hi{j} AS hi_b)" for i in range(k) for j in range(i, k))
    return nodes.selectExpr("node_id", "n", f"inline(array({cells}))")


def merge_moments(states: DataFrame, by: list[str]) -> DataFrame:
    """Long states merged for each pair and value of ``by``; one exchange of states."""
    keys = [*by, "i", "j"]
    n, group = F.col("n"), Window.partitionBy(*keys)
    centred = states.withColumns({f"all_{m}": F.sum(n * F.col(m)).over(group) / F.sum(n).over(group) for m in "ab"})
    off = F.col("c") + n * (F.col("a") - F.col("all_a")) * (F.col("b") - F.col("all_b"))
    return centred.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min("all_a").alias("a"), F.min("all_b").alias("b"), F.sum(off).alias("c"),
        *[F.min(f"lo_{m}").alias(f"lo_{m}") for m in "ab"], *[F.max(f"hi_{m}").alias(f"hi_{m}") for m in "ab"])


def pearson(a: Column, b: Column) -> Column:
    """Null when either side has no spread (ANSI-safe, no divide-by-zero)."""
    return F.round(F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)), CORR_DECIMALS)


def correlation_wide(raw: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """A8 + A18: one row per scope (each node and ``global``), one column per
    unordered sensor pair (21 for 7 sensors), plus the usable row count."""
    sensors = list(spec.corr_sensors)
    k = len(sensors)
    states = pair_moments(node_moments(raw, sensors), k)
    # each node's state counts for its own scope and, through one of MERGE_PARTS parts, for the global one
    own = F.struct(F.col("node_id").alias("scope"), F.lit(0).alias("part"))
    everywhere = F.struct(F.lit(GLOBAL).alias("scope"), F.pmod(F.hash("node_id"), F.lit(MERGE_PARTS)).alias("part"))
    placed = states.select("*", F.inline(F.array(own, everywhere))).drop("node_id")
    merged = merge_moments(merge_moments(placed, ["scope", "part"]).drop("part"), ["scope"])
    # null when either side has no spread, whatever rounding the merged moments hold
    squares = merged.groupBy("scope").agg(F.max("n").alias("n_rows"), *[
        F.expr(f"max(CASE WHEN i = {i} AND j = {j} AND lo_a < hi_a AND lo_b < hi_b THEN c END) AS c{i}_{j}")
        for i in range(k) for j in range(i, k)])
    return squares.selectExpr("scope", "n_rows", *[
        f"round(try_divide(c{i}_{j}, sqrt(c{i}_{i}) * sqrt(c{j}_{j})), {CORR_DECIMALS}) AS {pair_column(sensors[i], sensors[j])}"
        for i, j in combinations(range(k), 2)])


def correlation_pairs(raw: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """The key pairs as scalar columns, per scope."""
    wide = correlation_wide(raw, spec)
    index = {s: i for i, s in enumerate(spec.corr_sensors)}
    cols = []
    for label, a, b in spec.corr_pairs:
        x, y = (a, b) if index[a] < index[b] else (b, a)
        cols.append(F.col(pair_column(x, y)).alias(label))
    return wide.select("scope", *cols)


def correlation_long(raw: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """A10: the full symmetric matrix in long form (sensor_a, sensor_b,
    correlation) per scope, diagonal 1.0, built by unpivoting the wide row."""
    wide = correlation_wide(raw, spec)
    sensors = list(spec.corr_sensors)
    cells = []
    for a, b in combinations(sensors, 2):
        v = F.col(pair_column(a, b))
        cells.append(F.struct(F.lit(a).alias("sensor_a"), F.lit(b).alias("sensor_b"), v.alias("correlation")))
        cells.append(F.struct(F.lit(b).alias("sensor_a"), F.lit(a).alias("sensor_b"), v.alias("correlation")))
    for s in sensors:
        cells.append(F.struct(F.lit(s).alias("sensor_a"), F.lit(s).alias("sensor_b"),
                              F.lit(1.0).alias("correlation")))
    return (wide.select("scope", F.explode(F.array(*cells)).alias("c"))
            .select("scope", "c.sensor_a", "c.sensor_b", "c.correlation"))
