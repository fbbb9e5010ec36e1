"""Exact top-k search over integer vectors by a vector-approximation file.

Every component falls into one of 64 cells, whose marks are quantiles of a bounded sample; the file of cells
holds a byte per component beside each vector's smallest and largest component, which bound the two outer
cells. The search has two steps:

1. scan: blocks of queries meet blocks of the approximation file. Cells give every score a lower and an upper
   bound; a vector stays a candidate while its upper bound reaches the kth largest lower bound seen;
2. read: exact vectors come in the order of their bounds, a first batch of twice k. Its kth score is a floor
   under the result, so only candidates whose bound reaches the floor are read after it, then all is certain.

Equal vectors are one entry with as many smallest ids as a result can list, queries with equal vectors are
one query: a vector that a third of all rows share costs one row in every step. Only the number of
queries times the number of vectors decides the scan's work, and both are cut into blocks of fixed size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firesight.llm.common import table, written
from firesight.llm.vectors import by_length, distinct_queries, distinct_vectors, integer_rows, products, sample

#: Cells of a component; a byte holds one.
CELLS = 64
#: Vectors that the marks are fitted on, and components with marks of their own (others share one set).
SAMPLE, MARKED = 4096, 4096
#: Vectors and queries of a block; vectors of a step within a block.
VECTORS, QUERIES, STEP = 16384, 1024, 2048
K, SCALE, EVERY = 20, 64, 20

CANDIDATE = "q long, r long, low double, high double"


def fit_marks(vectors: DataFrame, rows: int = SAMPLE, cells: int = CELLS) -> np.ndarray:
    """A row of ascending marks for each of the first components, and a last one for all others."""
    parts = [m for _, m in by_length(pa.array(sample(vectors, rows), pa.binary()))]
    at = np.linspace(0, 1, cells + 1)[1:-1]
    pooled = np.concatenate([m.ravel() for m in parts])
    width = min(MARKED, max(m.shape[1] for m in parts))
    columns = [np.concatenate([m[:, j] for m in parts if m.shape[1] > j]) for j in range(width)]
    return np.stack([np.ceil(np.quantile(c, at)).astype("i8") if len(c) else np.zeros(len(at), "i8")
                     for c in (*columns, pooled)])


def cells_of(marks: np.ndarray):
    """Vectors to cells: cell c of a component holds marks[c - 1] <= x < marks[c]."""
    def run(batches):
        for batch in batches:
            out = [None] * batch.num_rows
            for at, x in by_length(batch.column("v")):
                code = np.empty(x.shape, "u1")
                for j in range(x.shape[1]):
                    code[:, j] = np.searchsorted(marks[min(j, len(marks) - 1)], x[:, j], side="right")
                ends = np.stack([x.min(1), x.max(1)], 1) if x.shape[1] else np.zeros((len(x), 2), "i8")
                for i, c, (lo, hi) in zip(at, code, ends.tolist()):
                    out[i] = (c.tobytes(), lo, hi)
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.record_batch([batch.column("r"), pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()),
                                   pa.array(cols[2], pa.int64())], names=["r", "cells", "lo", "hi"])
    return run


def _bounds(marks: np.ndarray, code: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Middle and half width of each component's cell, given the vectors' own smallest and largest components."""
    n = code.shape[1]
    own = marks[np.minimum(np.arange(n), len(marks) - 1)]
    at = np.arange(n)[None, :]
    last = marks.shape[1]
    low = np.where(code == 0, lo[:, None], own[at, np.maximum(code.astype("i8") - 1, 0)])
    high = np.where(code == last, hi[:, None], own[at, np.minimum(code, last - 1)] - 1)
    low, high = np.maximum(low, lo[:, None]), np.minimum(high, hi[:, None])
    return (low + high) / 2, (high - low) / 2


def scan_block(marks: np.ndarray, keep: int):
    """One block of the approximation file against one block of queries: the candidates that can be among ``keep``."""
    def run(files: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        cells = files.column("cells").combine_chunks()
        sizes = np.array([len(c) for c in cells.to_pylist()], "i8")
        r, lo, hi = (np.asarray(files.column(c)) for c in ("r", "lo", "hi"))
        q = np.asarray(queries.column("q"))
        for mine, x in by_length(queries.column("v")):
            same = np.flatnonzero(sizes == x.shape[1])
            x = x.astype("f8")
            floor = np.full((len(x), keep), -np.inf)
            parts = []
            for start in range(0, len(same), STEP):
                at = same[start:start + STEP]
                data = b"".join(cells.take(pa.array(at)).to_pylist())
                code = np.frombuffer(data, "u1").reshape(len(at), -1) if data else np.zeros((len(at), 0), "u1")
                middle, half = _bounds(marks, code, lo[at], hi[at])
                score, off = x @ middle.T, np.abs(x) @ half.T
                off += 2.0 ** -50 * x.shape[1] * np.abs(x).max(initial=0) * np.abs(middle).max(initial=0)
                low, high = score - off, score + off
                floor = -np.partition(-np.concatenate([floor, low], 1), keep - 1, axis=1)[:, :keep]
                a, b = np.nonzero(high >= floor.min(1)[:, None])
                parts.append((a, r[at][b], low[a, b], high[a, b]))
            if parts:
                a, b, low, high = (np.concatenate(c) for c in zip(*parts))
                stay = high >= floor.min(1)[a]
                found.append((q[mine][a[stay]], b[stay], low[stay], high[stay]))
        cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, t) for t in ("i8", "i8", "f8", "f8")]
        return pa.table(cols, names=["q", "r", "low", "high"])
    return run


def exact(batches):
    """(q, r, x, y) to exact scores; ``same``: the vectors are equal."""
    for batch in batches:
        score = np.zeros(batch.num_rows, "i8")
        same = np.zeros(batch.num_rows, bool)
        for (at, x), (_, y) in zip(by_length(batch.column("x")), by_length(batch.column("y"))):
            score[at] = np.einsum("ij,ij->i", x, y)
            same[at] = (x == y).all(1)
        yield pa.record_batch([batch.column("q"), batch.column("r"), pa.array(score), pa.array(same)],
                              names=["q", "r", "score", "same"])


def top_vectors(vectors: DataFrame, queries: DataFrame, keep: int) -> DataFrame:
    """q, r, score, same: at least every query's ``keep`` best distinct vectors of its length, exactly scored."""
    marks = fit_marks(vectors)
    cells = written(vectors.select("r", "v").mapInArrow(cells_of(marks), "r long, cells binary, lo long, hi long"), "topk-cells")
    n_files, n_queries = -(-cells.count() // VECTORS), -(-queries.count() // QUERIES)
    files = cells.withColumns({"_b": F.pmod(F.xxhash64("r"), F.lit(n_files)).cast("int"),
                               "_q": F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1)))})
    asked = queries.select("q", "v", F.pmod(F.xxhash64("q"), F.lit(n_queries)).cast("int").alias("_q"),
                           F.explode(F.sequence(F.lit(0), F.lit(n_files - 1))).alias("_b"))
    scanned = files.groupBy("_b", "_q").cogroup(asked.groupBy("_b", "_q")).applyInArrow(scan_block(marks, keep), CANDIDATE)

    mine = Window.partitionBy("q")
    nth = F.row_number().over(mine.orderBy(F.desc("low"), "r"))
    floor = F.max(F.when(F.col("_n") == keep, F.col("low"))).over(mine)
    possible = scanned.withColumn("_n", nth).withColumn("_floor", floor).filter(
        F.col("_floor").isNull() | (F.col("high") >= F.col("_floor")))
    candidates = written(possible.select("q", "r", "high", F.row_number().over(mine.orderBy(F.desc("high"), "r")).alias("place")),
                         "topk-candidates")

    def read(some: DataFrame) -> DataFrame:
        pairs = some.select("q", "r").join(vectors.select("r", F.col("v").alias("y")), "r").join(
            queries.select("q", F.col("v").alias("x")), "q")
        return pairs.select("q", "r", "x", "y").mapInArrow(exact, "q long, r long, score long, same boolean")

    first = written(read(candidates.filter(F.col("place") <= 2 * keep)), "topk-first")
    place = F.row_number().over(mine.orderBy(F.desc("score"), "r"))
    certain = first.withColumn("_n", place).filter(F.col("_n") == keep).select("q", F.col("score").alias("_floor"))
    # a query without such a score had all its candidates in the first batch
    rest = candidates.filter(F.col("place") > 2 * keep).join(certain, "q").filter(F.col("high") >= F.col("_floor"))
    return first.unionByName(read(rest))


def search(rows: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, id_col: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """Per row whose id is divisible by ``every``: its ``k`` best other rows by the inner product of
    ``floor(scale * x)``, ties to the smaller id: query_id, rank, vec_id, score.

    Rows with a null id or vector or with a null or non-finite component take no part. Vectors of
    different length have no inner product and don't meet; empty ones score 0. Repeated rows count once; rows that
    share an id but not the vector are rows (and queries) of their own, and a query leaves out its own row only.
    Fewer than k other rows: all of them. An empty table gives no rows; other columns aren't read.
    """
    taking = written(integer_rows(rows, scale, id_col, vector), "topk-rows")
    vectors = distinct_vectors(taking, k + 1, "topk-vectors")
    asking = taking.filter(F.col("vec_id") % every == 0)
    queries = distinct_queries(asking, "topk-queries")
    if queries.isEmpty():
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    scored = top_vectors(vectors, queries, k + 1).join(vectors.select("r", "ids"), "r").select(
        "q", "score", "same", F.explode("ids").alias("vec_id"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "same"))
    best = scored.withColumn("_n", place).filter(F.col("_n") <= k + 1).groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("_n", "vec_id", "score", "same"))).alias("best"))
    # queries of a hot vector are many rows of one key on the left, one row on the right: a join AQE can split
    answered = asking.select(F.col("vec_id").alias("query_id"), "v").join(
        queries.join(best, "q").select("v", "best"), "v")
    others = F.filter("best", lambda b: ~(b["same"] & (b["vec_id"] == F.col("query_id"))))
    return answered.select("query_id", F.posexplode(F.slice(others, 1, k))).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"),
        F.col("col.score").alias("score"))


def op12_topk(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"))


#: DuckDB twin.
ORACLE = f"""
WITH whole AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= {K}"""
