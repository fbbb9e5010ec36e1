"""Exact top-k search and hard negatives against their SQL and against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from firesight.llm import negatives, topk, vectors
from tests.llm.conftest import SMALL
from tests.llm.oracle import duck, same

SCHEMA = "vec_id long, embedding array<float>, label int, q long, r string, score string"
NAN, INF = float("nan"), float("inf")


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def cloud(rng, n, dim, centres=5, grid=None):
    """Clustered unit vectors, their components on a coarse grid if asked for (so that scores tie)."""
    middles = rng.normal(size=(centres, dim))
    x = middles[rng.integers(centres, size=n)] + rng.normal(size=(n, dim)) * 0.6
    x /= np.linalg.norm(x, axis=1)[:, None]
    return (np.round(x * grid) / grid if grid else x).astype("f4")


def taking(rows, scale):
    """Distinct (id, integer vector, label) of the rows that take part."""
    out = set()
    for i, v, label, *_ in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.add((i, tuple(max(-vectors.LIMIT, min(vectors.LIMIT, math.floor(scale * float(np.float32(x))))) for x in v), label))
    return sorted(out)


def scored(own, rows):
    """Rows of the same length other than ``own``, best first."""
    found = [(sum(a * b for a, b in zip(own[1], o[1])), o) for o in rows if o != own and len(o[1]) == len(own[1])]
    return sorted(found, key=lambda x: (-x[0], x[1][0]))


def plain_topk(rows, k, every, scale=64):
    rows = taking([(i, v, 0) for i, v, *_ in rows], scale)
    return Counter((q[0], n, o[0], s) for q in rows if q[0] % every == 0
                   for n, (s, o) in enumerate(scored(q, rows)[:k], 1))


def plain_negatives(rows, every, scale=256):
    rows, out = taking(rows, scale), []
    for a in rows:
        if a[0] % every == 0:
            near = scored(a, rows)
            for ps, p in [x for x in near if x[1][2] == a[2]][:5]:
                far = [(s, o) for s, o in near if o[2] != a[2] and 80 * ps <= 100 * s <= 100 * ps][:5]
                out += [(a[0], p[0], n, o[0], ps, s) for n, (s, o) in enumerate(far, 1)]
    return Counter(out)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def odd_rows(rng):
    """Nulls in every column, broken, empty, long and large vectors, ties, repeated rows and ids."""
    x = cloud(rng, 60, 6, grid=4)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    rows += [(None, x[0].tolist(), 1), (61, None, 1), (60, x[1].tolist(), None), (62, [0.5, None, 0.5, 0.5, 0.5, 0.5], 1),
             (63, [NAN] * 6, 0), (64, [INF] + [0.0] * 5, 0), (65, [], 0), (70, [], 1), (80, [], 1), (66, [0.0] * 6, 2),
             (67, [1e30] * 6, 1), (90, [-1e30] * 6, 1), (68, [0.25] * 3, 0), (100, [0.25] * 3, 1), (69, [0.5] * 3, 0),
             (110, rng.normal(size=5000).tolist(), 1), (120, rng.normal(size=5000).tolist(), 2)]
    return rows + [rows[0], rows[10], rows[10]] + [(10, x[20].tolist(), 1), (0, x[21].tolist(), 0)]


def hot_rows(rng, n=900):
    """A third of all rows share one vector, part of them under another label."""
    x = cloud(rng, n, 12, grid=8)
    x[::3] = x[0]
    return [(int(i), v.tolist(), int(i % 7 != 3) if i % 3 == 0 else int(i % 4)) for i, v in enumerate(x)]


def test_topk_equals_its_sql(spark):
    names, rows = duck(topk.ORACLE, SMALL)
    same(topk.op12_topk(spark, SMALL), names, rows)


@pytest.mark.parametrize("kind", ["cloud", "odd", "hot"])
def test_topk_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "VECTORS", 100)
    monkeypatch.setattr(topk, "QUERIES", 16)
    monkeypatch.setattr(topk, "STEP", 30)
    rng = np.random.default_rng(5)
    rows = {"cloud": lambda: [(i, v.tolist(), 0) for i, v in enumerate(cloud(rng, 800, 24))],
            "odd": lambda: odd_rows(rng), "hot": lambda: hot_rows(rng)}[kind]()
    random.Random(1).shuffle(rows)
    got = topk.search(table_of(spark, rows).repartition(4), k=7, every=10)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert bag(got) == plain_topk(rows, 7, 10)


def test_cells_bound_every_score():
    rng = np.random.default_rng(2)
    x = np.floor(64 * cloud(rng, 500, 16)).astype("i8")
    marks = np.stack([np.quantile(x[:50, j], np.linspace(0, 1, 17)[1:-1]).astype("i8") for j in range(16)] + [np.arange(15)])
    batch = pa.record_batch([pa.array(range(500), pa.int64()), pa.array([v.astype("<i4").tobytes() for v in x])], names=["r", "v"])
    files = pa.Table.from_batches(topk.cells_of(marks)([batch]))
    code = np.stack([np.frombuffer(c, "u1") for c in files.column("cells").to_pylist()])
    middle, half = topk._bounds(marks, code, *(np.asarray(files.column(c)) for c in ("lo", "hi")))
    assert (np.abs(x - middle) <= half).all()
    asked = pa.table([pa.array(range(500), pa.int64()), batch.column("v")], names=["q", "v"])
    found = topk.scan_block(marks, 5)(files, asked).to_pandas()
    truth = x @ x.T
    assert (found.low <= truth[found.q, found.r] + 1e-9).all() and (truth[found.q, found.r] <= found.high + 1e-9).all()
    best = {(q, r) for q in range(500) for r in np.argsort(-truth[q], kind="stable")[:5]}
    assert best <= set(zip(found.q, found.r)) and len(found) < 500 * 500 / 4


def test_negatives_equal_their_sql(spark):
    names, rows = duck(negatives.ORACLE, SMALL)
    same(negatives.op13_hard_negatives(spark, SMALL), names, rows)


@pytest.mark.parametrize("kind", ["cloud", "odd", "hot"])
def test_negatives_equal_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(negatives, "VECTORS", 40)
    monkeypatch.setattr(negatives, "ANCHORS", 8)
    monkeypatch.setattr(negatives, "SAMPLE", 300)
    monkeypatch.setattr(negatives.Tree.__init__, "__defaults__", (4, 20))
    rng = np.random.default_rng(6)
    rows = {"cloud": lambda: [(i, v.tolist(), i % 5) for i, v in enumerate(cloud(rng, 700, 8))],
            "odd": lambda: odd_rows(rng), "hot": lambda: hot_rows(rng)}[kind]()
    random.Random(1).shuffle(rows)
    got = negatives.hard_negatives(table_of(spark, rows).repartition(4), every=10)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(rows, 10)
    assert bag(got) == want and want


def test_tree_reaches_every_window_and_drops_siblings():
    rng = np.random.default_rng(9)
    x = np.floor(256 * cloud(rng, 3000, 4, centres=12)).astype("i8")
    tree = negatives.Tree([v.astype("<i4").tobytes() for v in x[:600]], (x ** 2).sum(1).max(), 6, 12)
    seen = {}
    leaf = tree.place(x, seen)
    for at, node in enumerate(tree.nodes):
        node.near, node.far = seen[at]
    score = x[:50] @ x.T
    base = (x[:50] ** 2).sum(1) + tree.norm2
    low = np.sort(score, axis=1)[:, -60]
    visits = {(i, lf) for lf, who in tree.reach(x[:50], np.zeros(50), np.sqrt(base - 2 * low)) for i in who.tolist()}
    need = {(i, int(leaf[j])) for i in range(50) for j in np.flatnonzero(score[i] >= low[i])}
    assert need <= visits and len(visits) < 50 * tree.leaves / 2


def test_searches_of_empty_tables(spark):
    none = table_of(spark, [(1, [0.5], 1)]).limit(0)
    assert topk.search(none).collect() == [] and negatives.hard_negatives(none).collect() == []
    # rows without queries, and rows of which none takes part
    some = table_of(spark, [(1, [0.5], 1), (20, None, 1), (100, [NAN], 1)])
    assert topk.search(some).collect() == [] and negatives.hard_negatives(some).collect() == []
    alone = table_of(spark, [(100, [0.5], 1)])
    assert topk.search(alone).collect() == [] and negatives.hard_negatives(alone).collect() == []


def test_relabelled(spark):
    rows = [(7, [0.1], 9), (14, [0.1], 3), (8, [0.1], 9), (21, [0.1], None)]
    got = [r[0] for r in table_of(spark, rows).select(negatives.relabelled()).collect()]
    assert got == [0, 4, 9, None]
    assert table_of(spark, rows).filter(F.col("score") == "y").count() == 4
