"""Exact quantiles per key by histogram refinement (A4, exact form).

Every target (a key's column at a point) has an interval of values that holds it and its rank within. A round
counts the values of each interval in ``BUCKETS`` equal parts, a partial aggregate whose shuffle carries counts,
smallest and largest value of each part; the part with the target's rank is the next interval, shrunk to the values
in it. Rounds end when no interval has more than ``leaf`` values or all are single values; what is left is
ranked by sorting the few values inside the intervals. No key's values are sorted or gathered, and only the size
of the largest interval reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firesight.functions.columns import q
from firesight.session import unique_shared_path

BUCKETS = 1024
#: Values of an interval that are ranked by sorting them.
LEAF = 1 << 16


def _stored(df: DataFrame) -> DataFrame:
    path = unique_shared_path(df.sparkSession, "quantiles")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _bucket(x: Column, lo: Column, hi: Column) -> Column:
    """Part of [lo, hi] that holds x; never falls as x rises. Halves keep the width finite."""
    share = F.try_divide(x / 2 - lo / 2, hi / 2 - lo / 2)
    part = F.when(F.isnan(share), F.lit(BUCKETS // 2)).otherwise(F.floor(share * (BUCKETS - 2)) + 1)
    return (F.when(x == lo, F.lit(0)).when(x == hi, F.lit(BUCKETS - 1))
            .otherwise(F.least(F.greatest(F.coalesce(part, F.lit(BUCKETS // 2)), F.lit(1)), F.lit(BUCKETS - 2))).cast("int"))


def _within(values: DataFrame, spans: DataFrame) -> DataFrame:
    """The values inside their key's and column's intervals."""
    right = spans.select(F.col("k").alias("_k"), F.col("s").alias("_s"), *[c for c in spans.columns if c not in ("k", "s")])
    cond = F.col("k").eqNullSafe(F.col("_k")) & (F.col("s") == F.col("_s"))
    return values.join(right, cond).filter(F.col("x").between(F.col("lo"), F.col("hi"))).drop("_k", "_s")


def exact_quantiles(df: DataFrame, key: str, columns: Sequence[str], points: Sequence[float], leaf: int = LEAF) -> DataFrame:
    """``k`` (the key), ``s`` (a column's place), ``i`` (a point's place) and ``x``: the smallest value that at least the
    point's share of the non-null values don't exceed. A column without values in a key gives no row."""
    cells = [F.struct(F.lit(s).alias("s"), q(c).cast("double").alias("x")) for s, c in enumerate(columns)]
    values = df.select(q(key).alias("k"), F.inline(F.array(*cells))).filter("x is not null")
    whole = values.groupBy("k", "s").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    ranks = [F.struct(F.lit(i).alias("i"), F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(Decimal(str(p))))).cast("long").alias("r"))
             for i, p in enumerate(points)]
    state = _stored(whole.select("k", "s", "n", "lo", "hi", F.inline(F.array(*ranks))))
    open_ = F.col("lo") < F.col("hi")
    before = None
    while True:
        largest, total = state.filter(open_).agg(F.max("n"), F.sum("n")).first()
        # intervals that no longer shrink hold neighbouring values, which sorting settles
        if not largest or largest <= leaf or (largest, total) == before:
            break
        before = (largest, total)
        spans = state.filter(open_).select("k", "s", "lo", "hi").distinct()
        counts = (_within(values, spans).withColumn("b", _bucket(F.col("x"), F.col("lo"), F.col("hi")))
                  .groupBy("k", "s", "lo", "hi", "b").agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("blo"), F.max("x").alias("bhi")))
        upto = F.sum("c").over(Window.partitionBy("k", "s", "lo", "hi").orderBy("b"))
        parts = counts.withColumn("upto", upto).select(
            F.col("k").alias("_k"), F.col("s").alias("_s"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
            "c", "upto", "blo", "bhi")
        hit = (F.col("k").eqNullSafe(F.col("_k")) & (F.col("s") == F.col("_s")) & (F.col("lo") == F.col("_lo"))
               & (F.col("hi") == F.col("_hi")) & (F.col("r") <= F.col("upto")) & (F.col("r") > F.col("upto") - F.col("c")))
        moved = state.filter(open_).join(parts, hit).select(
            "k", "s", F.col("c").alias("n"), F.col("blo").alias("lo"), F.col("bhi").alias("hi"), "i",
            (F.col("r") - F.col("upto") + F.col("c")).alias("r"))
        state = _stored(moved.unionByName(state.filter(~open_)))
    rank = F.row_number().over(Window.partitionBy("k", "s", "i").orderBy("x"))
    sorted_ = _within(values, state.filter(open_).drop("n")).withColumn("_n", rank).filter(F.col("_n") == F.col("r"))
    return sorted_.select("k", "s", "i", "x").unionByName(state.filter(~open_).select("k", "s", "i", F.col("lo").alias("x")))
