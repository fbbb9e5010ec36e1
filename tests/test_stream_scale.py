"""What a micro-batch costs follows its rows, not the session's partitions or the table's keys."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from firesight.sinks import keyed
from firesight.streaming import jobs
from tests.helpers import frame, reading


def test_state_and_sinks_have_a_micro_batchs_partitions(spark, workdir):
    """F4"""
    os.makedirs(f"{workdir}/src")
    with open(f"{workdir}/src/a.json", "w") as f:
        f.write('{"node_id": "a", "reading_index": 1, "ingest_ts": "2024-01-01T00:00:10.000Z", "CO": 1.0}\n')
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        q = jobs.start_windows(spark, jobs.read_stream(spark, f"{workdir}/src"), f"{workdir}/out", checkpoint=f"{workdir}/ck",
                               trigger={"availableNow": True})
        jobs.wait_for([q])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {p["stateOperators"][0]["numShufflePartitions"] for p in q.recentProgress if p["stateOperators"]} == {
        jobs.STREAM_PARTITIONS}


def test_sinks_of_a_batch_run_beside_each_other(spark):
    """each waits for the other; a failure is raised when all have ended."""
    both, ended = threading.Barrier(2), []

    def fails():
        both.wait(30)
        raise ValueError("no")

    def ends():
        both.wait(30)
        ended.append(spark.range(3).count())

    with pytest.raises(ValueError, match="no"):
        jobs._at_once(spark, [fails, ends])
    assert ended == [3]


def test_merged_files_follow_their_rows(spark, workdir):
    """a sink's session has no AQE; runs and bases have as many partitions as their rows fill."""
    target, conf = f"{workdir}/t", {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "30"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        keyed.write_batch(spark.range(2000).withColumn("v", F.lit(0)), target, 0, ["id"])
        keyed.maintain(spark, target, ["id"])
        for b in (1, 2):
            keyed.write_batch(spark.range(b * 100, b * 100 + 150).withColumn("v", F.lit(b)), target, b, ["id"])
        keyed.maintain(spark, target, ["id"], bucket_rows=100)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    run = keyed.live(spark, target).runs[0]
    assert 1 < len([f for f in os.listdir(run.path) if f.endswith(".parquet")]) <= 4
    got = {r.v: r.n for r in keyed.read_upserted(spark, target, ["id"]).groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 1750, 1: 100, 2: 150}


def test_an_empty_batch_writes_a_tables_columns_once(spark, workdir):
    """the batch that only advances the watermark costs the sinks nothing."""
    target, none = f"{workdir}/t", spark.range(0).withColumn("v", F.lit(1))
    keyed.store(none, target, 0, ["id"], empty=True)
    assert keyed.read_upserted(spark, target, ["id"]).columns == ["id", "v"]

    def fail(*a):
        raise AssertionError("written")

    with pytest.MonkeyPatch.context() as m:
        m.setattr(keyed, "write_batch", fail)
        keyed.store(none, target, 1, ["id"], empty=True)


def test_dedup_parts_are_alike_wherever_the_indexes_lie(spark, monkeypatch):
    """far-apart and null indexes; the null ones come last, as before."""
    from firesight.plans import queries as Q
    at = [i + (10 ** 7 if i >= 300 else 0) for i in range(600)]
    raw = frame(spark, [reading("a", i) for i in at] + [reading("a", None)])
    monkeypatch.setattr(Q, "_raw", lambda *a: raw)
    monkeypatch.setattr(Q, "_sent", lambda spark, parts, n, *a, **k: (parts, n))
    parts, n = Q.q_stream_dedup(spark, None)
    rows = parts.select("part", F.get_json_object("value", "$.reading_index").cast("long").alias("i")).collect()
    sizes = [sum(r.part == p for r in rows) for p in range(n)]
    assert len(rows) == 801 and max(sizes) < 2 * 801 / n
    assert [r.part for r in rows if r.i is None] == [n - 1]


def test_dedup_stream_reads_its_messages_once_and_restarts_four_times(spark, monkeypatch):
    """F1: each part is one micro-batch; the messages of a query don't pay a start for each, nor a second parse."""
    import datetime as dt
    from firesight.plans import queries as Q
    from tests.helpers import loop_enrich
    rows = [reading("ab"[i % 2], i, temp=20.0 + i * 7 % 11, co=1.0 + i % 5, fire=int(i % 40 > 30),
                    ts=dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i in range(600)]
    raw, runs, batches = frame(spark, rows), [], {}
    begin = jobs.start_enrichment
    monkeypatch.setattr(jobs, "start_enrichment", lambda *a, **k: runs.append(begin(*a, **k)) or runs[-1])

    def fed(start, sends):
        def noted():
            for send in sends:
                yield send
                batches.update({p["batchId"]: p["numInputRows"] for p in map(jobs._plain, runs[-1].recentProgress)
                                if p["numInputRows"]})
        feed(start, noted())

    feed = jobs.feed
    monkeypatch.setattr(jobs, "feed", fed)
    monkeypatch.setattr(Q, "_raw", lambda *a: raw)
    monkeypatch.setattr(Q, "STREAM_ROWS", 50)
    got = Q.q_stream_dedup(spark, None).collect()
    want = loop_enrich([{f.name: v for f, v in zip(raw.schema, r)} for r in rows])
    assert len(got) == len(want) and all(r[c] == v for r in got for c, v in want[r.node_id, r.reading_index].items())
    assert len(runs) == Q.STREAM_FILES and not any(q.isActive for q in runs)
    assert len(batches) == 12 and sum(batches.values()) == 800


@pytest.mark.slow
def test_dedup_passes_readings_without_a_time_once_the_watermark_has_moved(spark, workdir):
    """in one pass with the others; each counts, also equal ones of an earlier batch, and late ones go."""
    from tests.test_streaming import doc, write_file
    for n, (node, at) in enumerate([("a", "2024-01-01"), ("a", "2024-02-01"), ("b", "2024-02-02"), ("b", "2024-02-03")]):
        write_file(f"{workdir}/src", f"{n}.json", [doc(node, n, f"{at}T00:00:00.000Z", 20.0), doc("c", 7, None, 21.0),
                                                   doc("c", 7, None, 21.0), doc("c", 8, "soon", 22.0),
                                                   doc("a", 0, "2024-01-01T00:00:00.000Z", 20.0)])
    jobs.start_enrichment(spark, jobs.read_stream(spark, f"{workdir}/src", 1), f"{workdir}/out", checkpoint=f"{workdir}/ck",
                          trigger={"availableNow": True}, dedup="1 day").awaitTermination()
    tabs = jobs.read_tables(spark, f"{workdir}/out", ["cumulative", "processed_readings"])
    assert {r.node_id: r.total_processed for r in tabs["cumulative"].collect()} == {"a": 2, "b": 2, "c": 12}
    assert tabs["processed_readings"].count() == 6


def test_a_failing_feed_stops_its_query(spark, workdir):
    """F1"""
    from tests.test_streaming import write_file
    started = []

    def fail(batch, batch_id):
        raise ValueError("no")

    def start():
        started.append(jobs.read_stream(spark, f"{workdir}/src").writeStream.foreachBatch(fail)
                       .option("checkpointLocation", f"{workdir}/ck").start())
        return started[0]

    with pytest.raises(Exception, match="no"):
        jobs.feed(start, [lambda: write_file(f"{workdir}/src", "a.json", ["{}"])])
    assert not started[0].isActive


def test_a_base_is_written_without_another_exchange(spark, workdir):
    """old and newer rows write their buckets where they are, also when the number of buckets grows."""
    target, given = f"{workdir}/t", []
    with pytest.MonkeyPatch.context() as m:
        frames = type(spark.range(0))
        m.setattr(frames, "repartition", lambda df, *a, _as=frames.repartition: given.append(a) or _as(df, *a))
        for b, (lo, hi) in enumerate([(0, 2000), (1500, 3500), (0, 300)]):
            keyed.write_batch(spark.range(lo, hi).withColumn("v", F.lit(b)), target, b, ["id"])
            keyed.maintain(spark, target, ["id"], bucket_rows=200, full=True)
    assert given == [(16, keyed.KEY)] * 2 + [(32, keyed.KEY)]  # the newer rows only
    base = keyed.live(spark, target).base
    got = {r.v: r.n for r in keyed.read_upserted(spark, target, ["id"]).groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 1200, 1: 2000, 2: 300} and base.rows == 3500 and base.buckets == 32
    assert len([f for f in os.listdir(base.path) if f.endswith(".parquet")]) <= 2 * base.buckets
