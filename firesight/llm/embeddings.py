"""Embedding near-dedup with randomised-rotation binary codes.

A unit vector is turned by a random rotation and its signs are its code. With the
stored correction <o', o> (the dot product of the code, as a unit vector, with the
vector) the product of a code with another turned vector, divided by the correction,
is an unbiased estimate of the two vectors' inner product, and its error is bounded
with high confidence by a multiple of sqrt((1 - c^2) / c^2 / (D - 1)). A pair whose
estimate plus bound stays below the threshold is settled; the others are computed
again from the stored components in double precision, and only these make links.

Pairs come from blocks: vectors of a label whose codes agree on ``BITS`` chosen bits,
in several tables with rotations of their own. The number of tables follows from the
bits and the wanted recall of a pair that lies just at the threshold. A block of many
vectors is cut into pieces and each pair of pieces is a task of its own; tasks emit
counts and spanning links, never all pairs. A pair is counted in the first table
that it shares only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firesight.llm.common import table, tune, written
from firesight.llm.components import components

COSINE = 0.98
#: Chance that a pair just at the threshold shares no table.
MISS = 0.001
#: Widths of the confidence bound, in standard units of the estimate's error.
EPSILON = 4.0
#: Vectors per piece of a block.
PIECE = 512
SEED = 42


def rotations(dim: int, tables: int, seed: int = SEED) -> np.ndarray:
    """``tables`` random rotations of the space; the first one makes the stored codes."""
    rng = np.random.default_rng([seed, dim])
    out = []
    for _ in range(tables):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        out.append(q * np.sign(np.diag(r)))
    return np.array(out)


def plan_tables(rows: int, dim: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables): about one vector per block at random, and the tables that the recall needs."""
    bits = max(1, min(dim, math.ceil(math.log2(max(2, rows)))))
    # a bit of a pair at angle t agrees with chance 1 - t / pi
    agree = (1 - math.acos(min(1.0, cosine)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-agree))) if agree < 1 else 1


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that very large and small components don't overflow."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def block_keys(dim: int, bits: int, tables: int):
    """Adds ``_keys``: for each table the block of a vector."""
    def run(batches):
        turn = rotations(dim, tables)[:, :, :bits]
        for batch in batches:
            if not batch.num_rows:
                continue
            u = _unit(_vectors(batch.column("_v"), dim))
            keys = np.stack([((u @ t) > 0) @ (1 << np.arange(bits, dtype=np.int64)) for t in turn], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.tolist(), pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "_keys"])
    return run


def find_links(x: np.ndarray, y: np.ndarray, keys_x: np.ndarray, keys_y: np.ndarray, at: int, same: bool, turn: np.ndarray,
               cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of x and y that table ``at`` is the first to share and whose cosine reaches the threshold."""
    dim = x.shape[1]
    u, v = _unit(x), _unit(y)
    codes = np.where(v @ turn > 0, 1.0, -1.0) / math.sqrt(dim)
    correction = ((v @ turn) * codes).sum(axis=1)
    estimate = (u @ turn) @ codes.T / correction
    width = EPSILON * np.sqrt(np.maximum(0.0, 1 - correction ** 2) / correction ** 2 / max(1, dim - 1))
    maybe = estimate + width >= cosine
    if same:
        maybe &= np.arange(len(x))[:, None] < np.arange(len(y))[None, :]
    i, j = np.nonzero(maybe)
    if at:
        fresh = ~(keys_x[i, :at] == keys_y[j, :at]).any(axis=1)
        i, j = i[fresh], j[fresh]
    # exact, in double precision, in parts of bounded size
    good = []
    for s in range(0, len(i), 1 << 16):
        a, b = u[i[s:s + (1 << 16)]], v[j[s:s + (1 << 16)]]
        good.append((a * b).sum(axis=1) >= cosine)
    ok = np.concatenate(good) if good else np.zeros(0, bool)
    return i[ok], j[ok]


def _spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links of a forest with the same components as the links given."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _compare(dim: int, tables: int, cosine: float):
    """Rows of one task key (_t, _label, _key, _i, _j) in turn: partial link counts and spanning links."""
    turn = rotations(dim, tables)[0]

    def one(at, i, j, rows):
        ids = np.array([r[0] for r in rows], dtype=np.int64)
        times = np.array([r[1] for r in rows], dtype=np.int64)
        piece = np.array([r[2] for r in rows])
        x = np.array([r[3] for r in rows], dtype=np.float64)
        keys = np.array([r[4] for r in rows], dtype=np.int64)
        left, right = np.flatnonzero(piece == i), np.flatnonzero(piece == j)
        if not len(left) or not len(right):
            return []
        p, q = find_links(x[left], x[right], keys[left], keys[right], at, i == j, turn, cosine)
        a, b = left[p], right[q]
        n = np.zeros(len(ids), dtype=np.int64)
        np.add.at(n, a, times[b])
        np.add.at(n, b, times[a])
        some = np.flatnonzero(n)
        return [(int(ids[k]), None, int(n[k])) for k in some] + [(u, v, 0) for u, v in _spanning(ids[a], ids[b])]

    def run(batches):
        key, rows, out = None, [], []
        for batch in batches:
            for t, label, k, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (t, label, k, i, j) != key:
                    if rows:
                        out += one(key[0], key[3], key[4], rows)
                    key, rows = (t, label, k, i, j), []
                rows.append(row)
            if len(out) > 1 << 16:
                yield _links(out)
                out = []
        if rows:
            out += one(key[0], key[3], key[4], rows)
        yield _links(out)
    return run


def _links(rows):
    cols = list(zip(*rows)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "n"])


def near_duplicate_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                           cosine: float = COSINE, miss: float = MISS) -> DataFrame:
    """One row per row of ``rows``: id, ``n_links``, ``component_id``, ``kept``.

    Vectors are compared if their labels are equal and not null and their lengths agree. Null
    vectors, zero vectors and vectors with null or non-finite components link with nothing, nor do
    rows without a label; they get 0 links and their own id. Equal vectors of a label are one class
    and link with each other. Repeated ids: a row is a vector of its own, ``kept`` is true for every
    row that carries its component's smallest id; a null id is never the smallest unless all are null
    and is not kept unless alone. Empty input gives no rows; other columns aren't read.
    """
    spark = rows.sparkSession
    tune(spark)
    v = F.col("_v")
    fine = (v.isNotNull() & (F.size(v) > 0) & F.col("_label").isNotNull()
            & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
            & F.exists(v, lambda x: F.coalesce(x != 0, F.lit(False))))
    all_rows = rows.select(F.col(id_col).alias("_id"), F.col(vector).cast("array<double>").alias("_v"),
                           F.col(label).cast("string").alias("_label")).select(
        "_id", "_v", "_label", F.coalesce(fine, F.lit(False)).alias("_fine"))
    # -0.0 and 0.0 are equal: adding zero makes them the same bits
    signed = all_rows.withColumn("_v", F.transform("_v", lambda x: x + F.lit(0.0)))
    named = written(signed.withColumn("_class", F.when(F.col("_fine"), F.sha2(F.to_json(F.struct("_label", "_v")), 256))),
                    "embedding-rows")
    grouped = (named.filter("_fine").groupBy("_class").agg(F.count("*").alias("times"), F.min("_id").alias("least"),
                                                           F.first("_label").alias("_label"), F.first("_v").alias("_v")))
    classes = written(grouped.withColumn("c", F.xxhash64("_class")), "embedding-classes")

    found = []
    for dim, n in sorted(tuple(r) for r in classes.groupBy("_label", F.size("_v").alias("d")).count().groupBy("d").agg(
            F.max("count")).collect()):
        bits, tables = plan_tables(n, dim, cosine, miss)
        mine = classes.filter(F.size("_v") == dim).select("c", "times", "_label", "_v")
        keyed = written(mine.mapInArrow(block_keys(dim, bits, tables), "c long, times long, _label string, "
                                        "_v array<double>, _keys array<long>"), "embedding-keys")
        blocks = keyed.select("c", "_label", F.posexplode("_keys").alias("_t", "_key"))
        sizes = blocks.groupBy("_t", "_label", "_key").agg(F.count("*").alias("size")).filter("size > 1")
        # only vectors that meet another one travel with their components
        met = blocks.join(sizes, ["_t", "_label", "_key"]).select(
            "c", "_t", "_key", F.ceil(F.col("size") / PIECE).cast("int").alias("pieces"))
        piece = F.pmod(F.xxhash64("c", F.lit(1)), F.col("pieces")).cast("int")
        placed = met.join(keyed, "c").withColumn("_piece", piece)
        other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
        tasks = placed.withColumn("_o", other).select(
            "_t", "_label", "_key", F.least("_piece", "_o").alias("_i"), F.greatest("_piece", "_o").alias("_j"),
            "c", "times", "_piece", "_v", "_keys")
        unit = ["_t", "_label", "_key", "_i", "_j"]
        # a double's worth of components per row: batches stay small
        found.append(tasks.repartition(*[F.col(c) for c in unit]).sortWithinPartitions(*unit)
                     .mapInArrow(_compare(dim, tables, cosine), "a long, b long, n long"))
    if not found:
        return all_rows.select(F.col("_id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                               F.col("_id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionAll(more)
    links = written(links, "embedding-links")
    counts = links.filter("b is null").groupBy(F.col("a").alias("c")).agg(F.sum("n").alias("near"))
    roots = components(links.filter("b is not null"), "a", "b", "embedding-components").withColumnRenamed("node", "c")
    rooted = classes.select("c", "_class", "times", "least").join(roots, "c", "left").join(counts, "c", "left").select(
        "_class", "times", "least", F.coalesce("root", "c").alias("root"), F.coalesce("near", F.lit(0)).alias("near"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = rooted.join(smallest, "root").select("_class", (F.col("times") - 1 + F.col("near")).alias("n_links"), "component_id")
    out = named.select("_id", "_class").join(by_class, "_class", "left")
    component = F.coalesce("component_id", F.col("_id").cast("long"))
    return out.select(F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("_id").cast("long").eqNullSafe(component).alias("kept"))


def op6_embedding_dedup(spark, sf_dir):
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
