"""Physical-plan checks: pruning and pushdown reach the scan, no Python in
batch plans, the flagship query has no sort of history, bounded broadcasts."""

import pytest
from pyspark.sql import functions as F

from firesight.sources.readings import load_readings
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_prunes_scan_columns(spark):
    plan = plan_of(load_readings(spark, SF_SMALL).select("node_id", "CO"))
    schema = plan[plan.index("ReadSchema: "):].split()[1]
    assert schema == "struct<user_id:bigint,event_type:string,value:double>" or \
        schema == "<user_id:bigint,event_type:string,value:double>", schema


def test_filter_on_index_is_pushed_to_parquet(spark):
    plan = plan_of(load_readings(spark, SF_SMALL).filter(F.col("reading_index") > 500))
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id,500)]" in plan


def test_batch_queries_run_no_python(spark):
    from firesight.plans.queries import queries
    for name, fn in queries().items():
        if name.startswith("stream_"):
            continue
        plan = plan_of(fn(spark, SF_SMALL))
        assert "EvalPython" not in plan and "FlatMapGroupsInPandas" not in plan, name


@pytest.mark.parametrize("name", ["node_status", "latest_reading", "node_state", "cumulative_stats"])
def test_latest_rows_take_one_scan_and_no_sort(spark, name):
    """The plan at scale: without broadcasts chosen by size, one scan, hash aggregates, nothing sorted
    below the first exchange and only aggregated rows in exchanges."""
    from firesight.plans.queries import queries
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("FileScan parquet") == 1
    assert "Sort" not in plan and "Window" not in plan
    lines = [x.strip(" +-:") for x in plan.splitlines()]
    for above, below in zip(lines, lines[1:]):
        if above.startswith("Exchange"):
            assert below.startswith("HashAggregate"), (above, below)


def test_no_repartition_by_size(spark):
    assert "RoundRobin" not in plan_of(load_readings(spark, SF_SMALL))


def test_prefix_scan_partitions_by_node_and_chunk(spark):
    from firesight.operators.enrich import enrich
    plan = plan_of(enrich(load_readings(spark, SF_SMALL)))
    assert "hashpartitioning(node_id" in plan and "_chunk" in plan


def test_sql_functions_are_inlined(spark):
    """Functions in SQL text become plain expressions inside generated code."""
    from firesight.functions.catalog import register_functions
    names = register_functions(spark)
    assert {"fire_state_label", "map_status", "co_band"} <= set(names) and register_functions(spark) == names
    df = spark.sql("SELECT co_band(CO) AS band FROM {r} WHERE is_fire(CAST(user_id AS INT))",
                   r=spark.read.parquet(f"{SF_SMALL}/events.parquet").selectExpr("user_id", "value AS CO"))
    plan = plan_of(df)
    assert "Python" not in plan and "is_fire" not in plan and "co_band" not in plan and "CASE WHEN" in plan
    assert "Filter coalesce((cast(user_id" in plan and "*(1) Project" in plan


def test_stored_counts_come_from_the_footers(spark, workdir):
    from firesight.sinks import tables as T
    spark.range(50).write.parquet(f"{workdir}/a")
    df = T.stored_counts(spark, {"a": f"{workdir}/a"})
    assert "PushedAggregation: [COUNT(*)]" in plan_of(df) and df.first().row_count == 50
    # other scans are as they were
    assert "BatchScan" not in plan_of(spark.read.parquet(f"{workdir}/a"))
