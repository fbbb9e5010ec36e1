"""Column helpers, CSV/JSON sources and the sinks."""

import os

from pyspark.sql import functions as F

from firesight.functions import columns as C
from firesight.sinks import tables as T
from firesight.sources import csvfiles, envelope
from tests.helpers import frame, reading


def test_labels_and_map_status(spark):
    df = spark.createDataFrame([(None, False), (0, True), (1, False), (2, None), (-1, False)], "f int, a boolean")
    out = df.select(C.fire_state_label(F.col("f")).alias("l"), C.is_fire(F.col("f")).alias("i"),
                    C.map_status(F.col("f"), F.col("a")).alias("m"), C.fire_card(C.is_fire(F.col("f"))).alias("c"))
    rows = [tuple(r) for r in out.collect()]
    assert rows == [("N/A", False, 0, "NO FIRE"), ("NORMAL", False, 1, "NO FIRE"), ("FIRE", True, 2, "FIRE"),
                    ("SPECIAL", True, 2, "FIRE"), ("SPECIAL", False, 0, "NO FIRE")]


def test_bands_and_parse(spark):
    df = spark.createDataFrame([(None,), (4999.0,), (5000.0,), (12000.0,)], "g double")
    assert [r[0] for r in df.select(C.band(F.col("g"), (5000.0, 10000.0))).collect()] == [None, 0, 1, 2]
    ts = spark.createDataFrame([("2024-01-01T00:00:07.179Z",), ("junk",), (None,)], "s string")
    got = [r[0] for r in ts.select(C.iso_ts(C.parse_ts(F.col("s")))).collect()]
    assert got == ["2024-01-01T00:00:07.179Z", None, None]


def test_tolerant_csv_reads_each_file_by_its_own_header(spark, workdir):
    files = {
        "nodo_1": "Temperature (C),CO,Gas (Ohm),Smoke (ppm),Fire\n 21.5 ,abc,,nan, 2 \n22,1.5,100,0.02,1.0\n",
        "nodo_2": "Fire,Temperature (C),CO\n1,20,2\n\t2\t,1.0d,1f\n",  # the label first
        "nodo_3": "Temperature (C),CO\n" + "19,2\n" * 200,  # the largest file has none
        "nodo_4": "CO,Fire,Temperature (C)\n2,0,18\n",
        "nodo_5": "Temperature (C),CO\n",  # no rows
    }
    for name, text in files.items():
        with open(os.path.join(workdir, f"{name}.csv"), "w") as f:
            f.write(text)
    df = csvfiles.read_csv_readings(spark, workdir)
    rows = sorted(((r["node_id"], r["Temperature (C)"], r["CO"], r["Gas (Ohm)"], r["Smoke (ppm)"], r["Fire"])
                   for r in df.distinct().collect()), key=repr)
    assert rows == sorted([
        ("nodo_1", 21.5, None, None, None, 2), ("nodo_1", 22.0, 1.5, 100.0, 0.02, None),
        ("nodo_2", 20.0, 2.0, None, None, 1), ("nodo_2", None, None, None, None, 2),
        ("nodo_3", 19.0, 2.0, None, None, None), ("nodo_4", 18.0, 2.0, None, None, 0)], key=repr)
    assert df.count() == 205


def test_stored_nan_is_null_from_the_source_on(spark, workdir):
    from firesight.operators.baseline import baseline_summary
    from firesight.operators.enrich import enrich
    from firesight.sources.readings import read_readings
    nan = float("nan")
    frame(spark, [reading("a", i, temp=nan if i == 5 else 20.0 + i % 3) for i in range(40)]).write.parquet(f"{workdir}/r")
    stored = read_readings(spark, f"{workdir}/r")
    clean = frame(spark, [reading("a", i, temp=None if i == 5 else 20.0 + i % 3) for i in range(40)])
    assert sorted(map(repr, enrich(stored).collect())) == sorted(map(repr, enrich(clean).collect()))
    assert baseline_summary(stored).first() == baseline_summary(clean).first()


def test_sequence_index_matches_row_number(spark):
    import datetime as dt
    rows = [("a", i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=7 * i)) for i in range(40)]
    rows += [("b", 100 + i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=13 * i)) for i in range(9)]
    df = spark.createDataFrame(rows, "node_id string, event_id long, ts timestamp_ntz")
    out = csvfiles.assign_index(df, "ts", chunk_width=30_000_000, base_ts=F.lit("2024-01-01 00:00:00")
                                .cast("timestamp_ntz"))
    got = {(r["node_id"], r["event_id"]): (r["reading_index"], r["stamped_ts"]) for r in out.collect()}
    for node, start, n in (("a", 0, 40), ("b", 100, 9)):
        for i in range(n):
            idx, ts = got[(node, start + i)]
            assert idx == i and ts == dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=500 * i)


def test_decode_rejects_and_nan(spark):
    good = envelope.encode(frame(spark, [reading("a", 1, temp=21.0)]))
    docs = good.union(spark.createDataFrame(
        [("k", '{"node_id": "b", "reading_index": "x", "CO": "NaN", "Fire": 1}'), ("k", "{broken")],
        "key string, value string"))
    decoded = envelope.decode(docs, keep_rejects=True)
    ok, bad = envelope.split_rejects(decoded)
    got = {r["node_id"]: r for r in ok.collect()}
    assert got["a"]["Temperature (C)"] == 21.0 and got["a"]["ingest_ts"] == "2024-01-01T00:00:01.000Z"
    # a wrongly typed field becomes null; NaN becomes null (deviation: it never enters running state)
    assert got["b"]["reading_index"] is None and got["b"]["CO"] is None and got["b"]["Fire"] == 1
    assert [(r["key"], r["document"]) for r in bad.collect()] == [("k", "{broken")]


KEY = ["node_id", "reading_index"]


def state(spark, target):
    return {r["reading_index"]: r["Temperature (C)"] for r in T.read_upserted(spark, target, KEY).collect()}


def test_write_batch_replay_is_idempotent(spark, workdir):
    target = f"{workdir}/t"
    v1 = frame(spark, [reading("a", 0, temp=1.0), reading("a", 1, temp=1.0)])
    v2 = frame(spark, [reading("a", 1, temp=2.0)])
    for df, batch in ((v1, 0), (v2, 1), (v2, 1)):  # batch 1 is replayed
        T.write_batch(df, target, batch, KEY, C.order_value(df))
    assert state(spark, target) == {0: 1.0, 1: 2.0}
    assert T.read_batches(spark, target).count() == 3


def test_last_write_within_a_batch_is_the_latest_by_time(spark, workdir):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [reading("a", 0, temp=float(i), ts=t + dt.timedelta(seconds=i)) for i in range(30)]
    for n, order in enumerate((rows, rows[::-1], rows[15:] + rows[:15])):
        df = frame(spark, order).repartition(7)
        T.write_batch(df, f"{workdir}/t{n}", 0, KEY, C.order_value(df))
        assert state(spark, f"{workdir}/t{n}") == {0: 29.0}


def test_compaction_is_followed_by_readers_and_writers(spark, workdir):
    target = f"{workdir}/t"
    for batch, temp in enumerate((1.0, 2.0, 3.0)):
        df = frame(spark, [reading("a", i, temp=temp) for i in range(batch, 4)])
        T.write_batch(df, target, batch, KEY, C.order_value(df))
    before = state(spark, target)
    assert T.compact(spark, target, KEY) == 1
    assert state(spark, target) == before and T.read_batches(spark, target).count() == 4
    T.write_batch(df, target, 2, KEY, C.order_value(df))  # the last batch is replayed
    assert state(spark, target) == before
    T.write_batch(frame(spark, [reading("a", 0, temp=9.0)]), target, 3, KEY)
    assert state(spark, target) == {**before, 0: 9.0}
    assert T.compact(spark, target, KEY) == 2
    assert state(spark, target) == {**before, 0: 9.0}


def test_upsert_has_no_sort_aggregate(spark):
    df = frame(spark, [reading("a", 0)]).selectExpr("*", "0L batch", "1L seq")
    plan = T.upsert_latest(df, KEY, ["batch", "seq"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_mirror_failure_does_not_raise(spark, workdir):
    df = frame(spark, [reading("a", 0)])
    assert T.write_mirror(df, f"{workdir}/m") is True
    assert T.write_mirror(df, f"{workdir}/m2", fmt="no-such-format") is False
    T.write_snapshot(df.select("node_id"), f"{workdir}/s")
    T.write_snapshot(df.select("node_id", "reading_index"), f"{workdir}/s")
    assert spark.read.parquet(f"{workdir}/s").columns == ["node_id", "reading_index"]


def test_dedup_retention_serving_alerts_audit(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 10)
    rows = [reading("a", 0, ts=t0 - dt.timedelta(days=8)), reading("a", 1, ts=t0, fire=1),
            reading("a", 1, ts=t0, fire=1)]
    df = frame(spark, rows)
    assert T.dedup(df, ["node_id", "reading_index"]).count() == 2
    assert T.apply_retention(df, "7 days").count() == 2
    from firesight.operators.enrich import enrich, fire_events
    enriched = enrich(df)
    serving = T.to_serving(enriched)
    assert "temperature_c" in serving.columns and "Temperature (C)" not in serving.columns
    al = T.alerts(fire_events(enriched)).collect()[0]
    assert '"fire_value":1' in al["payload"] and '"fire_value_prev":0' in al["payload"]
    audit = {r["table_name"]: r["row_count"] for r in T.audit_counts({"raw": df, "enriched": enriched}).collect()}
    assert audit == {"raw": 3, "enriched": 3}
