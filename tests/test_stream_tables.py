"""What a running stream does to its tables: it merges them, and reads none of them for the status."""

import json
import os

import pytest
from pyspark.sql import functions as F

from firesight.operators.enrich import ENRICH_COLUMNS, enrich
from firesight.sinks import keyed as K
from firesight.sources.envelope import decode, encode
from firesight.sources.readings import load_readings
from firesight.streaming import jobs
from firesight.streaming import processor as P
from tests.test_plans import plan_of
from tests.test_streaming import messages, write_file

SMALL = "/root/testdata/sf0.001"


@pytest.mark.slow
def test_a_stream_merges_its_tables_by_itself(spark, workdir):
    from firesight.functions.columns import clean
    from firesight.operators.rollups import cumulative_stats
    from firesight.operators.status import coords_table, node_status
    src, root = f"{workdir}/src", f"{workdir}/out"
    for i in range(5):
        write_file(src, f"m-{i}.json", messages(spark, 120 * i, 120 * (i + 1)))
    q = jobs.start_enrichment(spark, jobs.read_stream(spark, src, 1), root, checkpoint=f"{workdir}/ck",
                              trigger={"availableNow": True}, every=2)
    q.awaitTermination()
    tables = [t for t in os.listdir(root)]
    assert {"processed_readings", "cumulative", "node_status", "alerts", "batch_counters"} <= set(tables)
    for t in tables:
        assert K.live(spark, f"{root}/{t}").covered >= 3, t  # batches 0 to 3 are merged, batch 4 is not
    raw = decode(encode(load_readings(spark, SMALL).filter("reading_index < 600")))
    tabs = jobs.read_tables(spark, root, ["processed_readings", "node_status", "cumulative", "batch_counters"])
    cols = ["node_id", "reading_index", *ENRICH_COLUMNS]
    assert sorted(map(repr, tabs["processed_readings"].select(*cols).collect())) == sorted(
        map(repr, enrich(raw).select(*cols).collect()))
    want = node_status(clean(raw), coords_table(spark))
    assert sorted(map(repr, tabs["node_status"].select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    mine = ["node_id", "total_processed", *[c for c in tabs["cumulative"].columns if c.startswith("running_")]]
    whole = cumulative_stats(clean(raw).withColumn("batch_id", F.lit(0)))
    got, exp = ({r.node_id: r for r in d.select(*mine).collect()} for d in (tabs["cumulative"], whole))
    assert set(got) == set(exp)
    for node in exp:
        for c in mine[1:]:
            assert got[node][c] == pytest.approx(exp[node][c], abs=1e-3), c
    assert tabs["batch_counters"].agg(F.sum("rows")).first()[0] == whole.agg(F.sum("total_processed")).first()[0]


@pytest.mark.slow
def test_a_batch_reads_no_table_for_its_status(spark, workdir, monkeypatch):
    """The status' plan holds the batch alone, in every batch; its work doesn't grow with the history."""
    src, root, plans = f"{workdir}/src", f"{workdir}/out", []
    for i in range(4):
        write_file(src, f"m-{i}.json", messages(spark, 50 * i, 50 * (i + 1)))
    plain = jobs.live_status

    def seen(s, batch, *a):
        df = plain(s, batch, *a)
        plans.append(plan_of(df))
        return df

    monkeypatch.setattr(jobs, "live_status", seen)
    jobs.start_enrichment(spark, jobs.read_stream(spark, src, 1), root, checkpoint=f"{workdir}/ck",
                          trigger={"availableNow": True}).awaitTermination()
    assert len(plans) == 4
    for plan in plans:
        assert "FileScan" not in plan and "InMemoryTableScan" in plan and "HashAggregate" not in plan.split("InMemoryRelation")[0]


def test_totals_add_up_over_pieces():
    import pandas as pd
    names = P.DEFAULT_SPEC.serving_names
    cols = [names[c] for c, *_ in P.ROLLUP_SENSORS]
    one = pd.DataFrame({c: [1.5, None, 3.0] for c in cols})
    two = pd.DataFrame({c: [None, None] for c in cols}, dtype="float64")
    totals = P.add_totals(two, {})
    assert totals["total_processed"] == 2 and totals["sum_temp"] is None and totals["max_gas"] is None
    totals = P.add_totals(two, P.add_totals(one, P.add_totals(one, totals)))
    assert (totals["total_processed"], totals["sum_co"], totals["min_co"], totals["max_co"]) == (10, 9.0, 1.5, 3.0)
    out = P.with_totals(one.copy(), totals)
    assert out["_totals_total_processed"].isna().tolist() == [True, True, False] and out["_totals_sum_co"].iloc[2] == 9.0
    assert P.with_totals(one.copy(), None)["_totals_sum_co"].isna().all()




@pytest.mark.slow
def test_repeated_messages_leave_scores_and_counters_unchanged(spark, workdir):
    """Repeats within a file and in a later one; a message without a time passes unchecked."""
    lines = messages(spark, 0, 90)
    untimed = json.dumps({"node_id": "nodo_1", "reading_index": 5000, "CO": 1.0, "Gas (Ohm)": 5.0, "ingest_ts": "junk"})
    tables = []
    for n, (first, second) in enumerate(((lines[:60], lines[60:]),
                                         (lines[:60] + lines[:30], lines[20:60] + lines[60:] + [untimed] + lines[80:]))):
        src, root = f"{workdir}/src{n}", f"{workdir}/out{n}"
        write_file(src, "a.json", first)
        write_file(src, "b.json", second)
        jobs.start_enrichment(spark, jobs.read_stream(spark, src, 1), root, checkpoint=f"{workdir}/ck{n}",
                              trigger={"availableNow": True}, dedup="1 day").awaitTermination()
        tabs = jobs.read_tables(spark, root, ["processed_readings", "batch_counters", "cumulative"])
        # the message without a time comes last, with the largest index
        rows = tabs["processed_readings"].filter("reading_index < 5000")
        tables.append((sorted(map(repr, rows.select("node_id", "reading_index", *ENRICH_COLUMNS).collect())),
                       tabs["batch_counters"].agg(F.sum("rows")).first()[0], tabs["processed_readings"].count()))
    (plain, rows, n), (again, rows2, n2) = tables
    assert again == plain and rows2 == rows + 1 and n2 == n + 1


@pytest.mark.slow
def test_late_rows_are_counted(spark, workdir):
    from tests.test_streaming import doc
    src, root = f"{workdir}/src", f"{workdir}/out"
    write_file(src, "a.json", [doc("a", 0, "2024-01-01T00:00:10.000Z", 20.0)])
    write_file(src, "b.json", [doc("a", 1, "2024-01-01T00:30:00.000Z", 20.0)])
    write_file(src, "c.json", [doc("a", 2, "2024-01-01T00:30:01.000Z", 20.0)])
    write_file(src, "d.json", [doc("a", 3, "2024-01-01T00:00:11.000Z", 20.0), doc("b", 4, "2024-01-01T00:00:12.000Z", 20.0)])
    q = jobs.start_windows(spark, jobs.read_stream(spark, src, 1), root, checkpoint=f"{workdir}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    for _ in range(2):  # stored twice, counted once
        jobs.store_progress(spark, {"windows": q}, root)
    got = jobs.read_tables(spark, root, ["progress"])["progress"]
    assert got.agg(F.sum("late_rows"), F.sum("input_rows")).first() == (2, 5)
    assert {r.query for r in got.collect()} == {"windows"} and got.filter("watermark is not null").count() > 0
