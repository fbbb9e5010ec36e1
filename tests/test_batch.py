"""Baseline, detection quality, correlation and roll-ups on hand-made rows."""

from pyspark.sql import functions as F

from firesight.functions import columns as C
from firesight.operators import baseline as B
from firesight.operators.correlate import correlation_long, correlation_pairs, correlation_wide
from firesight.operators.quality import detection_quality
from firesight.operators.windows import window_stats
from tests.helpers import frame, reading


def test_quality_zero_denominators_and_unlabelled(spark):
    rows = [reading("a", 0, fire=0), reading("a", 1, fire=0), reading("b", 0, fire=None)]
    out = {r["node_id"]: r for r in detection_quality(frame(spark, rows)).collect()}
    assert set(out) == {"a"}
    a = out["a"]
    assert (a["tp"], a["fp"], a["tn"], a["fn"]) == (0, 0, 2, 0)
    assert (a["precision"], a["recall"], a["f1"], a["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_quality_counts_null_sensor_as_not_passed(spark):
    rows = [reading("a", 0, fire=1, co=None, temp=None, smoke=None, gas=None),
            reading("a", 1, fire=1, co=60.0), reading("a", 2, fire=0, temp=36.0)]
    a = detection_quality(frame(spark, rows)).collect()[0]
    assert (a["tp"], a["fp"], a["tn"], a["fn"]) == (1, 1, 0, 1)
    assert a["precision"] == 0.5 and a["recall"] == 0.5 and a["f1"] == 0.5


def test_correlation_edge_cases(spark):
    rows = [reading("one", 0, temp=20.0, NO2=1.0)]
    rows += [reading("const", i, temp=20.0, co=float(i), NO2=float(i % 3), gas=1000.0 * i) for i in range(5)]
    rows += [reading("drop", 0, temp=None, NO2=1.0)]
    wide = {r["scope"]: r for r in correlation_wide(frame(spark, rows)).collect()}
    assert "drop" not in wide  # listwise deletion removed its only row
    assert wide["one"]["corr_temp_co"] is None  # one usable row
    assert wide["const"]["corr_temp_co"] is None  # constant temperature
    assert wide["const"]["corr_gas_co"] == 1.0
    assert wide["global"]["n_rows"] == 6
    long = correlation_long(frame(spark, rows)).filter("scope = 'const'").collect()
    assert len(long) == 49
    diag = [r for r in long if r["sensor_a"] == r["sensor_b"]]
    assert all(r["correlation"] == 1.0 for r in diag)
    pairs = correlation_pairs(frame(spark, rows)).filter("scope = 'const'").collect()[0]
    assert pairs["corr_co_gas"] == 1.0


def test_correlation_is_one_scan(spark):
    from firesight.sources.readings import load_readings
    plan = correlation_wide(load_readings(spark, "/root/testdata/sf0.001"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("FileScan") == 1 or plan.count("Scan parquet") == 1


def test_hourly_trend_nested_matches_flat_and_empty(spark):
    from firesight.sources.readings import load_readings
    raw = load_readings(spark, "/root/testdata/sf0.001")
    flat = {(r["node_id"], r["hour"]): r["avg_temp"] for r in B.hourly_trend(raw).collect()}
    nested = B.hourly_trend_nested(raw).collect()
    got = {(r["node_id"], e["hour"]): e["avg_temp"] for r in nested for e in r["trend_hourly"]}
    assert got == flat
    for r in nested:
        hours = [e["hour"] for e in r["trend_hourly"]]
        assert hours == sorted(hours)


def test_report_node_without_hours_gets_empty_trend(spark):
    rows = [reading("a", 0), reading("b", 0)]
    df = frame(spark, rows).withColumn(
        "ingest_ts", F.when(F.col("node_id") == "a", F.lit(None)).otherwise(F.col("ingest_ts")))
    rep = {r["node_id"]: r for r in B.baseline_report(df).collect()}
    assert rep["a"]["trend_hourly"] == []
    assert rep["a"]["total_readings"] == 1 and rep["a"]["first_ingest_ts"] is None
    assert len(rep["b"]["trend_hourly"]) == 1


def test_report_nested_matches_flat(spark):
    from firesight.sources.readings import load_readings
    raw = load_readings(spark, "/root/testdata/sf0.001")
    nested = B.baseline_report(raw).drop("trend_hourly")
    flat = B.baseline_report(raw, nested=False)
    assert nested.exceptAll(flat.select(*nested.columns)).count() == 0


def test_window_stats_counts_null_sensor_rows_and_drops_null_time(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, 0, 0, 10)
    rows = [reading("a", 0, ts=t, temp=None), reading("a", 1, ts=t + dt.timedelta(seconds=20), temp=30.0),
            reading("a", 2, ts=t + dt.timedelta(minutes=1)), ]
    df = frame(spark, rows).union(frame(spark, [reading("a", 3)]).withColumn("ingest_ts", F.lit(None)))
    out = window_stats(df).orderBy("window_start").collect()
    assert [r["reading_count"] for r in out] == [2, 1]
    assert out[0]["avg_temp"] == 30.0


def test_percentiles_single_scan_of_sketches(spark):
    from firesight.sources.readings import load_readings
    p = B.baseline_percentiles(load_readings(spark, "/root/testdata/sf0.001"))
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan or "SortAggregate" in plan or "HashAggregate" in plan
    assert p.count() == 4
