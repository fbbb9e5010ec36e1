"""Chunks by the number of rows, exact quantiles and merged co-moments."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from firesight.operators import chunks, correlate, enrich as E
from firesight.operators.quantiles import exact_quantiles
from firesight.sources import csvfiles
from tests.helpers import frame, reading
from tests.test_plans import plan_of

T0 = dt.datetime(2024, 1, 1)


def test_no_chunk_has_more_rows_than_asked_for(spark):
    """Half of a node's rows on one index, another node's all without index on one day."""
    rng = random.Random(3)
    rows = [reading("a", 7 if i % 2 else i, temp=rng.gauss(20, 3), ts=T0 + dt.timedelta(seconds=i)) for i in range(900)]
    rows += [reading("b", None, temp=rng.gauss(20, 3), ts=T0 + dt.timedelta(seconds=rng.randrange(50))) for _ in range(500)]
    df = frame(spark, rows).repartition(5)
    assert E.largest_chunk(df, 100) > 400
    cut = E.by_rows(df, 100).groupBy("node_id", E.CHUNK).agg(
        F.count("*").alias("n"), F.min(F.struct(E.ORD, "ingest_ts")).alias("lo"), F.max(F.struct(E.ORD, "ingest_ts")).alias("hi"))
    got = cut.orderBy("node_id", E.CHUNK).collect()
    assert max(r.n for r in got) <= 100 and sum(r.n for r in got) == len(rows)
    for one, two in zip(got, got[1:]):  # chunks of a node rise with its order
        assert one.node_id != two.node_id or one.hi <= two.lo


@pytest.mark.parametrize("cuts", ["rows", "auto"])
def test_enrichment_over_row_chunks_equals_the_window(spark, cuts):
    rng = random.Random(5)
    rows = [reading("a", 7 if i % 2 else i, temp=round(rng.gauss(20, 3), 2), fire=rng.choice([0, 1, None]),
                    ts=T0 + dt.timedelta(seconds=i)) for i in range(400)]
    rows += [reading("b", i, co=float(i % 9)) for i in range(50)]
    df = frame(spark, rows)
    got, want = (E.enrich(df, chunk_rows=37, cuts=cuts), E.enrich(df, method="window"))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_index_of_a_hot_hour(spark):
    rng = random.Random(1)
    rows = [("a", i, T0 + dt.timedelta(seconds=rng.randrange(40))) for i in range(700)]
    rows += [("b", 1000 + i, T0 + dt.timedelta(hours=i)) for i in range(30)] + [(None, 2000, T0), ("c", 2001, None)]
    df = spark.createDataFrame(rows, "node_id string, event_id long, ts timestamp_ntz").repartition(6)
    out = csvfiles.assign_index(df, "ts", base_ts=F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), tie="event_id")
    assert out.columns == ["node_id", "event_id", "ts", "reading_index", "stamped_ts"]
    got = {(r.node_id, r.event_id): r.reading_index for r in out.collect()}
    for node in ("a", "b", "c", None):
        mine = sorted((r for r in rows if r[0] == node), key=lambda r: (r[2] or dt.datetime.min, r[1]))
        assert [got[r[0], r[1]] for r in mine] == list(range(len(mine)))


@pytest.mark.parametrize("leaf", [40, 10_000])
def test_exact_quantiles(spark, leaf):
    rng = random.Random(2)
    inf = float("inf")
    kinds = {"normal": [rng.gauss(0, 1) for _ in range(700)], "ties": [float(rng.randrange(3)) for _ in range(500)],
             "one": [4.5], "wide": [10.0 ** rng.randrange(-9, 9) * rng.choice([1, -1]) for _ in range(400)],
             "ends": [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324] * 20, "infinite": [inf, -inf, 1.0, 2.0, 3.0] * 9,
             None: [1.0, 2.0, 3.0, 4.0], "none": [None] * 5}
    rows = [(k, x, None if x is None else -x) for k, xs in kinds.items() for x in xs]
    df = spark.createDataFrame(rows, "key string, x double, `y (z)` double").repartition(4)
    points = (0.0, 0.25, 0.5, 0.95, 0.99, 1.0)
    got = {(r.k, r.s, r.i): r.x for r in exact_quantiles(df, "key", ["x", "y (z)"], points, leaf).collect()}
    want = {}
    for k, xs in kinds.items():
        for s, sign in ((0, 1), (1, -1)):
            v = sorted(sign * x for x in xs if x is not None)
            for i, p in enumerate(points):
                if v:
                    want[k, s, i] = v[max(1, math.ceil(round(p * len(v), 9))) - 1]
    assert got == want


def test_quantile_rounds_sort_no_rows(spark):
    """A node's values are counted, not sorted, while more than ``leaf`` are left."""
    from firesight.operators import quantiles
    df = spark.range(5000).selectExpr("'a' AS key", "cast(id * 7 % 5000 AS double) AS x")
    sizes = []
    plain = quantiles._within
    try:
        quantiles._within = lambda v, s: (sizes.append(s.columns), plain(v, s))[1]
        got = exact_quantiles(df, "key", ["x"], [0.5], leaf=10).collect()
    finally:
        quantiles._within = plain
    assert got[0].x == 2499.0 and len(sizes) == 2  # one round of counting, then at most ten values sorted


def test_merged_moments_equal_numpy(spark):
    """Far means and small spreads: merged co-moments stay right, and no row is expanded."""
    rng = np.random.default_rng(7)
    sensors = list(correlate.DEFAULT_SPEC.corr_sensors)
    n = 4000
    node = rng.integers(0, 300, n)
    x = rng.normal(size=(n, len(sensors))) * 1e-3 + 1e5 + (node[:, None] % 5) * 1e-3
    x[:, 1] = x[:, 0] * 2 + rng.normal(size=n) * 1e-3
    x[:, 2] = 0.1
    rows = [(f"n{k}", *map(float, v)) for k, v in zip(node, x)]
    df = spark.createDataFrame(rows, "node_id string, " + ", ".join(f"`{s}` double" for s in sensors)).repartition(7)
    wide = correlate.correlation_wide(df)
    assert "Expand" not in plan_of(wide)
    got = {r.scope: r for r in wide.collect()}
    assert len(got) == len(set(node)) + 1 and got["global"].n_rows == n
    for scope, mine in [("global", np.ones(n, bool)), ("n3", node == 3), ("n77", node == 77)]:
        r = np.corrcoef(np.delete(x[mine], 2, axis=1).T)
        names = [s for i, s in enumerate(sensors) if i != 2]
        for i, a in enumerate(names):
            for j in range(i + 1, len(names)):
                assert got[scope][correlate.pair_column(a, names[j])] == pytest.approx(r[i, j], abs=2e-4)
        assert got[scope][correlate.pair_column(sensors[0], sensors[2])] is None
    assert chunks.PLACE_BITS == 33
