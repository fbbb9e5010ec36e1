"""Integer vectors for the exact searches: rows, distinct vectors, matrices and exact inner products.

A vector travels as the bytes of its 32-bit components, so equal vectors are equal keys. Components are
``floor(scale * x)``; beyond +-2^20 they count as that limit, so that a score always fits a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firesight.llm.common import tune, written

LIMIT = 1 << 20


def integer_rows(rows: DataFrame, scale: int, id_col: str, vector: str, label=None) -> DataFrame:
    """``vec_id``, ``v`` (bytes) and ``label`` (a column, else 0) of the rows that take part, repeated ones once.

    Rows with a null id, label or vector or with a null or non-finite component take no part.
    """
    tune(rows.sparkSession)
    fine = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                       F.col(f"`{vector}`").cast("array<double>").alias("x"),
                       (F.lit(0) if label is None else label).cast("long").alias("label")).filter(
        "vec_id is not null and label is not null and x is not null")

    def run(batches):
        for batch in batches:
            x = batch.column("x")
            flat, at = x.flatten(), np.asarray(x.offsets, "i8")
            values = np.asarray(flat.fill_null(np.nan), "f8")
            ends = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            base = at - at[0]
            keep = np.flatnonzero(ends[base[1:]] == ends[base[:-1]])
            whole = np.clip(np.floor(scale * np.nan_to_num(values)), -LIMIT, LIMIT).astype("<i4")
            v = [whole[base[i]:base[i + 1]].tobytes() for i in keep]
            yield pa.record_batch([batch.column("vec_id").take(pa.array(keep)), pa.array(v, pa.binary()),
                                   batch.column("label").take(pa.array(keep))], names=["vec_id", "v", "label"])

    return fine.mapInArrow(run, "vec_id long, v binary, label long").dropDuplicates()


def distinct_vectors(rows: DataFrame, ids: int, name: str) -> DataFrame:
    """The distinct (label, v) as a written table with a number ``r`` and their ``ids`` smallest ids.

    The row number's limit works before the shuffle, so a vector that a third of all rows share is a few
    rows per task. More ids than a result may list can't be in it.
    """
    place = Window.partitionBy("label", "v").orderBy("vec_id")
    first = rows.withColumn("_n", F.row_number().over(place)).filter(F.col("_n") <= ids)
    return written(first.groupBy("label", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                   .withColumn("r", F.monotonically_increasing_id()), name)


def distinct_queries(rows: DataFrame, name: str) -> DataFrame:
    """The distinct (label, v) of the querying rows as a written table with a number ``q``."""
    return written(rows.select("label", "v").dropDuplicates().withColumn("q", F.monotonically_increasing_id()), name)


def by_length(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of 64-bit integers) for each number of components; ``column``: vectors as bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pc.binary_length(column)) // 4 if len(column) else np.zeros(0, int)
    out = []
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        data = b"".join(column.take(pa.array(at)).to_pylist())
        flat = np.frombuffer(data, "<i4") if data else np.zeros(0, "<i4")
        out.append((at, flat.reshape(len(at), int(n)).astype("i8")))
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two integer matrices, exact: in doubles where their sums stay exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype("f8") @ b.T.astype("f8")).astype("i8") if most < 1 << 53 else a @ b.T


def sample(vectors: DataFrame, rows: int) -> list[bytes]:
    """At most ``rows`` vectors, by the hash of their numbers: a bounded, repeatable sample for fitting."""
    return [bytes(x.v) for x in vectors.orderBy(F.xxhash64("r"), "r").limit(rows).select("v").collect()]
