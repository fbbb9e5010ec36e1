"""Stored keyed tables: merge on read without exchanging the base, levels, clean-up, failures."""

import os
import random

import pytest
from pyspark.sql import functions as F

from firesight.sinks import keyed as K
from tests.test_plans import plan_of

KEY = ["k", "n"]


def batch(spark, rows):
    return spark.createDataFrame(rows, "k long, n string, x long, `t (x)` timestamp")


def rows_of(rng, b, keys=60):
    return [(rng.randrange(keys), rng.choice([None, "a"]), 1000 * b + i, None) for i in range(20)]


def last(rows):
    """One row per key as a batch writes it, by the order given (here x)."""
    out = {}
    for r in rows:
        if (r[0], r[1]) not in out or r[2] > out[r[0], r[1]][2]:
            out[r[0], r[1]] = r
    return out


def state(spark, target):
    return {(r.k, r.n): tuple(r) for r in K.read_upserted(spark, target, KEY).collect()}


def test_levels_hold_the_newest_rows(spark, workdir):
    rng, target, want, levels = random.Random(4), f"{workdir}/t", {}, set()
    for b in range(14):
        rows = rows_of(rng, b, keys=60 if b else 2000)
        if not b:
            rows = [(i, "a", i, None) for i in range(2000)] + [(None, None, 1, None)]
        want |= last(rows)
        df = batch(spark, rows)
        K.write_batch(df, target, b, KEY, F.col("x"))
        if b % 2 == 1:
            K.maintain(spark, target, KEY, b, fan=2, share=0.05, bucket_rows=500)
            at = K.live(spark, target)
            levels |= {p.level for p in at.runs}
            assert at.covered == b and (at.base is None or at.base.buckets & (at.base.buckets - 1) == 0)
        if b in (0, 1, 6, 13):
            assert state(spark, target) == want
    assert {1, 2} <= levels
    at = K.live(spark, target)
    # the newer part stays a bounded share of the base, and old folders are gone but for one version
    assert sum(p.rows for p in at.runs) < 0.05 * at.base.rows
    assert len(os.listdir(f"{target}/base")) <= 2 and len(K.versions(spark, target)) == 2
    assert K.compact(spark, target, KEY) == at.version + 1
    assert state(spark, target) == want and K.live(spark, target).runs == []


def test_a_table_of_many_batches_is_read_without_exchanging_its_base(spark, workdir):
    target = f"{workdir}/t"
    rows = spark.range(20_000).selectExpr("id % 7000 AS k", "'a' AS n", "id AS x", "cast(null AS timestamp) AS `t (x)`",
                                          "id div 100 AS batch_id")  # 200 batches
    rows.repartition(4, "batch_id").write.partitionBy("batch_id").parquet(f"{target}/deltas")
    K.maintain(spark, target, KEY, 189, bucket_rows=1000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = K.read_upserted(spark, target, KEY)
        plan = plan_of(df)
        lines = [x.strip(" +-:") for x in plan.splitlines()]
        base = next(i for i, x in enumerate(lines) if "firesight_base_" in x)
        assert "Bucketed: true" in lines[base] and lines[base - 1].startswith("ShuffledHashJoin")
        assert not any("Exchange" in x for x in lines[:base])
        # what is exchanged are the batches after the base
        for i, x in enumerate(lines):
            if x.startswith("Exchange"):
                assert "hashpartitioning(_merge_key" in x and "deltas" in next(y for y in lines[i:] if "FileScan" in y)
        got = {r.k: r.x for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {k: max(range(k, 20_000, 7000)) for k in range(7000)}
    # the filter on a column reaches both scans
    plan = plan_of(K.read_upserted(spark, target, KEY).filter("x > 19000"))
    assert plan.count("GreaterThan(x,19000)") >= 1


def test_another_session_reads_the_base(spark, workdir):
    target = f"{workdir}/t"
    K.write_batch(batch(spark, [(1, "a", 1, None)]), target, 0, KEY)
    K.compact(spark, target, KEY)
    name = os.listdir(f"{target}/base")[0]
    spark.sql(f"DROP TABLE firesight_base_{name}")  # what the log says is enough
    assert state(spark, target) == {(1, "a"): (1, "a", 1, None)}


def test_a_failure_before_the_mark_changes_nothing(spark, workdir, monkeypatch):
    target = f"{workdir}/t"
    for b in range(3):
        K.write_batch(batch(spark, [(b, "a", b, None), (0, None, b, None)]), target, b, KEY)
    before = state(spark, target)
    with monkeypatch.context() as m:
        m.setattr(K, "_commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            K.compact(spark, target, KEY)
    assert state(spark, target) == before and K.live(spark, target).version == 0
    assert K.compact(spark, target, KEY) == 1 and state(spark, target) == before
    K.write_batch(batch(spark, [(9, "a", 9, None)]), target, 3, KEY)
    K.compact(spark, target, KEY)
    assert len(os.listdir(f"{target}/base")) == 2  # the failed attempt's folder went with the next clean-up


def test_tables_without_keys_keep_all_rows(spark, workdir):
    target = f"{workdir}/t"
    for b in range(6):
        K.store(batch(spark, [(1, "a", b, None)] * 2), target, b, every=2)
    at = K.live(spark, target)
    assert at.covered == 5 and K.read_batches(spark, target).count() == 12
    K.store(batch(spark, [(1, "a", 6, None)]), target, 6, every=2)
    assert sorted(r.x for r in K.read_batches(spark, target).collect()) == sorted([*range(6)] * 2 + [6])


def test_store_merges_by_itself(spark, workdir):
    target, want, rng = f"{workdir}/t", {}, random.Random(8)
    for b in range(7):
        rows = rows_of(rng, b)
        want |= last(rows)
        K.store(batch(spark, rows), target, b, KEY, F.col("x"), every=3)
    at = K.live(spark, target)
    assert at.version == 2 and at.covered == 5 and state(spark, target) == want
    K.store(batch(spark, rows), target, 6, KEY, F.col("x"), every=3)  # a replay
    K.write_batch(batch(spark, [(1, "a", -5, None)]), target, 4, KEY)  # a late replay of a merged batch is not read
    assert state(spark, target) == want


def test_a_table_without_rows_has_its_columns(spark, workdir):
    K.write_batch(batch(spark, []), f"{workdir}/t", 0, KEY)
    K.write_batch(batch(spark, []), f"{workdir}/u", 0)
    assert K.read_upserted(spark, f"{workdir}/t", KEY).columns == ["k", "n", "x", "t (x)"]
    assert K.read_batches(spark, f"{workdir}/u").count() == 0
    K.maintain(spark, f"{workdir}/t", KEY)
    assert state(spark, f"{workdir}/t") == {}


def test_a_failed_snapshot_leaves_the_old_one(spark, workdir):
    from firesight.sinks import tables as T
    path = f"{workdir}/out/report"
    T.write_snapshot(spark.range(5), path)
    broken = spark.range(100).withColumn("id", F.expr("if(id = 77, raise_error('no'), id)"))
    with pytest.raises(Exception, match="no"):
        T.write_snapshot(broken, path)
    assert spark.read.parquet(path).count() == 5
    T.write_snapshot(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7
    assert [n for n in os.listdir(f"{workdir}/out") if n.endswith("-old")] == []


def test_retention_reads_and_keeps_only_the_days_inside(spark, workdir):
    import datetime as dt
    from firesight.sinks import tables as T
    path, end = f"{workdir}/dated", dt.datetime(2024, 1, 20, 12)
    rows = [(i, end - dt.timedelta(hours=6 * i)) for i in range(60)] + [(99, None)]
    T.write_dated(spark.createDataFrame(rows, "x long, ingest_ts timestamp_ntz"), path)
    kept = {i for i, t in rows if t is not None and t >= end - dt.timedelta(days=3)}
    df = T.read_retained(spark, path, "3 days", end)
    assert {r.x for r in df.collect()} == kept and df.columns == ["x", "ingest_ts"]
    plan = plan_of(df)  # days outside aren't listed among the partitions to read
    assert "PartitionFilters: [isnotnull(date" in plan and ">= 2024-01-17" in plan
    before = {f for d, _, fs in os.walk(path) for f in (f"{d}/{x}" for x in fs) if "date=2024-01-1" in d or "date=2024-01-2" in d}
    gone = T.purge(spark, path, "3 days", end)
    assert gone and max(gone) == "2024-01-16" and {r.x for r in T.read_retained(spark, path, "3 days", end).collect()} == kept
    left = {f for d, _, fs in os.walk(path) for f in (f"{d}/{x}" for x in fs)}
    assert {f for f in before if "2024-01-17" <= f.split("date=")[1][:10]} <= left  # later files untouched
    assert spark.read.parquet(path).filter("x = 99").count() == 1 and T.purge(spark, path, "3 days", end) == []
