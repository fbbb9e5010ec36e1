"""Streaming: stream equals batch, restart with state, late data, replay."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from firesight.operators.enrich import ENRICH_COLUMNS, enrich
from firesight.sinks import tables as T
from firesight.sources.envelope import decode, encode
from firesight.sources.readings import load_readings
from firesight.streaming import jobs


def write_file(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, "." + name)
    with open(tmp, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.rename(tmp, os.path.join(folder, name))
    time.sleep(1.05)  # distinct modification times keep file order


def messages(spark, lo, hi):
    raw = load_readings(spark, "/root/testdata/sf0.001").filter((F.col("reading_index") >= lo) &
                                                                (F.col("reading_index") < hi))
    return [r["value"] for r in encode(raw).orderBy(F.get_json_object("value", "$.reading_index").cast("long"))
            .collect()]


def run_enrichment(spark, src, root, ckpt):
    q = jobs.start_enrichment(spark, jobs.read_stream(spark, src, 1), root, checkpoint=ckpt,
                              trigger={"availableNow": True})
    q.awaitTermination()
    return q


@pytest.mark.slow
def test_stream_equals_batch_and_restart(spark, workdir):
    src, root, ckpt = f"{workdir}/src", f"{workdir}/out", f"{workdir}/ckpt"
    write_file(src, "m-000.json", messages(spark, 0, 300))
    write_file(src, "m-001.json", messages(spark, 300, 620))
    q = run_enrichment(spark, src, root, ckpt)
    # rate control: one file per micro-batch, so the state is carried across two batches
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2
    # rerun without new files emits nothing new
    before = T.read_batches(spark, f"{root}/processed_readings").count()
    run_enrichment(spark, src, root, ckpt)
    assert T.read_batches(spark, f"{root}/processed_readings").count() == before
    # a new file continues from the committed state
    write_file(src, "m-002.json", messages(spark, 620, 1000))
    run_enrichment(spark, src, root, ckpt)
    got = T.read_upserted(spark, f"{root}/processed_readings", ["node_id", "reading_index"])
    exp = enrich(decode(encode(load_readings(spark, "/root/testdata/sf0.001"))))
    cols = ["node_id", "reading_index", *ENRICH_COLUMNS]
    assert got.count() == exp.count()
    assert got.select(*cols).exceptAll(exp.select(*cols)).count() == 0
    tabs = jobs.read_tables(spark, root, ["cumulative", "node_status", "fire_events", "alerts", "batch_counters"])
    cum = {r["node_id"]: r["total_processed"] for r in tabs["cumulative"].collect()}
    assert sum(cum.values()) == exp.count()
    from firesight.operators.status import coords_table, node_status
    from firesight.functions.columns import clean
    want = node_status(clean(decode(encode(load_readings(spark, "/root/testdata/sf0.001")))), coords_table(spark))
    assert sorted(map(repr, tabs["node_status"].select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    assert tabs["fire_events"].count() == exp.filter("is_fire_transition").count() == tabs["alerts"].count()
    assert tabs["batch_counters"].agg(F.sum("rows")).first()[0] == exp.count()


def doc(node, idx, ts, temp):
    return json.dumps({"node_id": node, "reading_index": idx, "ingest_ts": ts, "Temperature (C)": temp,
                       "CO": 1.0, "Gas (Ohm)": 1000.0, "Smoke (ppm)": 0.01, "Fire": 0})


@pytest.mark.slow
def test_window_watermark_drops_late_rows(spark, workdir):
    src, root = f"{workdir}/src", f"{workdir}/out"
    write_file(src, "w-000.json", [doc("a", 0, "2024-01-01T00:00:10.000Z", 20.0),
                                   doc("a", 1, "2024-01-01T00:00:20.000Z", 22.0)])
    write_file(src, "w-001.json", [doc("a", 2, "2024-01-01T00:10:00.000Z", 30.0)])  # advances the watermark
    # Late rows are filtered with the watermark of the previous micro-batch, so
    # one more batch passes before the advanced watermark applies to input.
    write_file(src, "w-002.json", [doc("b", 5, "2024-01-01T00:10:05.000Z", 30.0)])
    write_file(src, "w-003.json", [doc("a", 3, "2024-01-01T00:00:30.000Z", 99.0),     # late: dropped
                                   doc("a", 4, "2024-01-01T00:10:30.000Z", 40.0)])    # open window: re-emitted
    q = jobs.start_windows(spark, jobs.read_stream(spark, src, 1), root, checkpoint=f"{workdir}/ck",
                           trigger={"availableNow": True})
    q.awaitTermination()
    out = {r["window_start"]: r for r in T.read_upserted(spark, f"{root}/window_stats",
                                                         ["node_id", "window_start"]).collect()
           if r["node_id"] == "a"}
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress
                  if p["stateOperators"])
    assert dropped == 1
    first = out[dt.datetime(2024, 1, 1, 0, 0)]
    assert first["reading_count"] == 2 and first["max_temp"] == 22.0
    ten = out[dt.datetime(2024, 1, 1, 0, 10)]
    assert ten["reading_count"] == 2 and ten["avg_temp"] == 35.0
    # the open window was written twice (update mode), the upsert keeps the last
    assert T.read_batches(spark, f"{root}/window_stats").filter(
        (F.col("window_start") == dt.datetime(2024, 1, 1, 0, 10)) & (F.col("node_id") == "a")).count() == 2


def test_stream_dedup_within_watermark(spark, workdir):
    src = f"{workdir}/src"
    write_file(src, "d-000.json", [doc("a", 0, "2024-01-01T00:00:10.000Z", 20.0),
                                   doc("a", 0, "2024-01-01T00:00:10.000Z", 20.0),
                                   doc("a", 1, "2024-01-01T00:00:11.000Z", 21.0)])
    d = decode(jobs.read_stream(spark, src, 1)).withColumn("event_ts", F.col("ingest_ts").cast("timestamp"))
    deduped = T.dedup(d.withWatermark("event_ts", "2 minutes"), ["node_id", "reading_index"])
    q = (deduped.writeStream.format("memory").queryName("dedup_t").option("checkpointLocation", f"{workdir}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("select count(*) from dedup_t").collect()[0][0] == 2


@pytest.mark.slow
def test_streams_then_batch_job(spark, workdir):
    """All queries on one source, then the batch job over what they stored."""
    from firesight.batch.job import run_batch
    from firesight.functions.columns import clean
    from firesight.operators.baseline import baseline_report
    src, root = f"{workdir}/src", f"{workdir}/out"
    write_file(src, "b-000.json", [*messages(spark, 0, 200), "{broken"])
    queries = jobs.run_all(spark, src, root, trigger={"availableNow": True}, checkpoint_root=f"{workdir}/ck")
    assert all(q.exception() is None and not q.isActive for q in queries)
    tabs = jobs.read_tables(spark, root, ["raw_readings", "rejects", "processed_readings", "window_stats"])
    raw = decode(encode(load_readings(spark, "/root/testdata/sf0.001").filter(F.col("reading_index") < 200)))
    assert tabs["raw_readings"].count() == raw.count()
    assert [r["document"] for r in tabs["rejects"].collect()] == ["{broken"]
    assert tabs["processed_readings"].count() == clean(raw).count()
    assert tabs["window_stats"].agg(F.sum("reading_count")).collect()[0][0] == raw.count()
    at = dt.datetime(2024, 5, 1)
    written = run_batch(spark, root, f"{workdir}/snap", f"{workdir}/mirror", at)
    report = written["baseline_report"]
    assert {r["report_generated_at"] for r in report.collect()} == {at}
    want = baseline_report(raw)
    assert sorted(map(repr, report.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    assert spark.read.json(f"{workdir}/mirror/correlation").count() == written["correlation"].count()


@pytest.mark.slow
def test_a_failing_query_stops_the_others(spark, workdir):
    src = f"{workdir}/src"
    write_file(src, "f-000.json", messages(spark, 0, 20))

    def fail(batch, batch_id):
        raise ValueError("no")

    lines = jobs.read_stream(spark, src)
    good = (lines.writeStream.format("noop").option("checkpointLocation", f"{workdir}/c1")
            .trigger(processingTime="1 second").start())
    bad = lines.writeStream.foreachBatch(fail).option("checkpointLocation", f"{workdir}/c2").start()
    with pytest.raises(Exception, match="no"):
        jobs.wait_for([good, bad])
    assert not good.isActive and not bad.isActive


@pytest.mark.slow
def test_stream_honours_the_spec(spark, workdir):
    from dataclasses import replace
    from firesight.spec import DEFAULT_SPEC
    spec = replace(DEFAULT_SPEC, z_threshold=0.5, thresholds=(("CO", "CO", ">", 5.0),), scored=DEFAULT_SPEC.scored[:2])
    src, root = f"{workdir}/src", f"{workdir}/out"
    write_file(src, "p-000.json", messages(spark, 0, 300))
    q = jobs.start_enrichment(spark, jobs.read_stream(spark, src), root, checkpoint=f"{workdir}/ck",
                              trigger={"availableNow": True}, spec=spec)
    q.awaitTermination()
    raw = decode(encode(load_readings(spark, "/root/testdata/sf0.001").filter(F.col("reading_index") < 300)))
    cols = ["node_id", "reading_index", "zscore_Temperature", "zscore_CO", "is_anomaly", "anomaly_sensors", "fire_value_prev"]
    got = T.read_upserted(spark, f"{root}/processed_readings", ["node_id", "reading_index"]).select(*cols)
    want = enrich(raw, spec).select(*cols)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.slow
def test_stream_state_equals_batch_key_state(spark, workdir):
    from firesight.functions.columns import clean
    from firesight.operators.status import node_state
    src = f"{workdir}/src"
    write_file(src, "s-000.json", messages(spark, 0, 250))
    write_file(src, "s-001.json", messages(spark, 250, 500))
    run_enrichment(spark, src, f"{workdir}/out", f"{workdir}/ck")
    got = {r["node_id"]: r.asDict() for r in jobs.read_stream_state(spark, f"{workdir}/ck").collect()}
    raw = load_readings(spark, "/root/testdata/sf0.001").filter(F.col("reading_index") < 500)
    exp = {r["node_id"]: r.asDict() for r in node_state(clean(raw)).collect()}
    assert set(got) == set(exp)
    for node, e in exp.items():
        g = got[node]
        assert g["last_fire_value"] == e["last_fire_value"]
        for name in ("Temperature", "CO", "Smoke", "Gas"):
            assert g[f"{name}_count"] == e[f"{name}_count"]
            assert g[f"{name}_mean"] == pytest.approx(e[f"{name}_mean"], rel=1e-9, abs=1e-6)
            assert g[f"{name}_m2"] == pytest.approx(e[f"{name}_m2"], rel=1e-9)


def test_registered_streams_grow_in_bounded_parts(spark, monkeypatch):
    """Null indexes are sent, and more messages are more micro-batches of more files."""
    from firesight.plans import queries as Q
    raw = load_readings(spark, "/root/testdata/sf0.001")
    raw = raw.withColumn("reading_index", F.when(F.col("reading_index") != 7, F.col("reading_index")))
    sent = []
    monkeypatch.setattr(Q, "_raw", lambda *a: raw)
    monkeypatch.setattr(Q, "STREAM_ROWS", 200)
    monkeypatch.setattr(Q, "FILE_ROWS", 50)
    monkeypatch.setattr(jobs, "wait_for", lambda qs: (qs[0].awaitTermination(), sent.extend(
        p["numInputRows"] for p in qs[0].recentProgress if p["numInputRows"])))
    got = Q.q_stream_raw(spark, None)
    n = raw.count()
    assert sum(sent) == got.count() == n and got.filter("reading_index is null").count() == 1
    assert len(sent) == -(-n // 200) > 4 and max(sent) < 2 * 200


def test_a_node_is_scored_in_pieces(monkeypatch):
    import numpy as np
    import pandas as pd
    from firesight.spec import DEFAULT_SPEC
    from firesight.streaming import processor as P
    rng = np.random.default_rng(5)
    n, names = 1000, DEFAULT_SPEC.serving_names
    pdf = pd.DataFrame({names.get(c, c): rng.normal(20, 3, n).round(2) for c, _, _ in DEFAULT_SPEC.scored})
    pdf[names["Fire"]] = pd.array(rng.integers(0, 2, n), dtype="Int32")
    pdf["reading_index"] = pd.array(rng.permutation(n) // 2, dtype="Int64")
    pdf.loc[3, "reading_index"] = pd.NA
    pdf["ingest_ts"] = [f"t{x:04d}" for x in rng.permutation(n)]
    frames = [pdf.iloc[i:i + 130] for i in range(0, n, 130)]
    whole, state = P.score_frame(P.order_rows(pdf), {})
    seen, scored, held = [], P.score_frame, {}
    monkeypatch.setattr(P, "PIECE", 64)
    monkeypatch.setattr(P, "score_frame", lambda f, *a: (seen.append(len(f)), scored(f, *a))[1])
    e = P.Enricher()
    e.fields = P.state_schema().fieldNames()
    e.state = type("S", (), {"exists": lambda s: False, "update": lambda s, v: held.update(zip(e.fields, v))})()
    got = pd.concat(list(e.handleInputRows(("n",), iter(frames), None)), ignore_index=True)
    assert max(seen) <= 64 and got["ingest_ts"].tolist() == whole["ingest_ts"].tolist()
    zs = [c for c in got.columns if c.startswith("zscore_")]
    assert np.allclose(got[zs].astype(float), whole[zs].astype(float), atol=1.1 * 10.0 ** -DEFAULT_SPEC.z_decimals)
    assert got[P.PREV_FIRE].tolist()[1:] == whole[P.PREV_FIRE].tolist()[1:]
    assert all(np.isclose(held[f], state[f]) for f in e.fields)
