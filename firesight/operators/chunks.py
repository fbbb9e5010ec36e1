"""Chunks of consecutive rows, cut by their number and not by the width of a key range.

Rows are range-partitioned by (key, order), sorted inside each partition and written to the shared folder with
their partition and their place in it; a chunk is ``chunk_rows`` places of a partition. Spark samples the
range bounds, but the places are exact: no chunk has more than ``chunk_rows`` rows, however many rows share an
hour or an index (rows that agree in the whole order go by ``tie``). The table is written because a
second evaluation could sample other bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firesight.session import unique_shared_path

#: Bits of a place within a partition, as Spark numbers rows.
PLACE_BITS = 33
PART, PLACE = "_part", "_place"


def sorted_parts(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """``df`` as a written table, sorted by key and order over all partitions, with PART and PLACE (from 0)."""
    spark = df.sparkSession
    by = [F.col(f"`{key}`"), *[F.col(c) if isinstance(c, str) else c for c in order]]
    number = F.monotonically_increasing_id()
    path = unique_shared_path(spark, "sorted")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
     .withColumns({PART: F.shiftright(number, PLACE_BITS), PLACE: number.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))})
     .write.parquet(path))
    return spark.read.parquet(path)


def chunk_of(chunk_rows: int) -> Column:
    """The chunk of a row of ``sorted_parts``: rises with the order of a key's rows."""
    return F.col(PART) * F.lit(1 << PLACE_BITS) + F.floor(F.col(PLACE) / F.lit(int(chunk_rows)))


def place_in_key(stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``sorted_parts`` with ``_n``: their place from 0 among all rows of their key.

    A key's rows in a partition are consecutive: place less the key's first place there, plus what earlier
    partitions hold of the key. The counts are one row per key and partition that it reaches into.
    """
    sizes = stored.groupBy(PART, key).agg(F.min(PLACE).alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(F.col(PART).alias("_p"), F.col(f"`{key}`").alias("_k"),
                         (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    joined = stored.join(shift, (F.col(PART) == F.col("_p")) & F.col(f"`{key}`").eqNullSafe(F.col("_k")))
    return joined.withColumn("_n", F.col(PLACE) + F.col("_shift")).drop("_p", "_k", "_shift")
