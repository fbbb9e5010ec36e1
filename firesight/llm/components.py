"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firesight.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node reachable.

    ``edges`` holds links between long ids in columns ``a`` and ``b``, in any
    order, with repeats and self-links allowed; null ends are ignored. Each round
    is written to the shared folder, so lineage stays short and a lost executor
    costs one round. Only a count and a checksum reach the driver. The minima are
    map-side aggregates, and the joins are free for AQE to split at a hot centre.
    """
    e = written(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
                .filter("u <> v").distinct(), name)

    def mark(df):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    before = mark(e)
    while before[0]:
        e = written(_small_star(_large_star(e).distinct()).filter("u <> v").distinct(), name)
        after = mark(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
