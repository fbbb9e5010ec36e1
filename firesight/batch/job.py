"""The batch job: report and correlation over the stored history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from firesight.operators.baseline import baseline_report
from firesight.operators.correlate import correlation_long
from firesight.sinks import tables as T
from firesight.spec import DEFAULT_SPEC, SensorSpec
from firesight.streaming.jobs import read_tables


def run_batch(spark: SparkSession, root: str, out: str, mirror: str | None = None,
              generated_at: dt.datetime | None = None, spec: SensorSpec = DEFAULT_SPEC) -> dict[str, DataFrame]:
    """Read the raw readings that the streams stored under ``root``, write the per-node baseline
    report (with ``report_generated_at``) and the correlation matrix as snapshots under ``out``, and
    copy them to ``mirror``, whose failures are logged only. Returns the written tables.
    """
    raw = read_tables(spark, root, ["raw_readings"])["raw_readings"]
    at = generated_at or dt.datetime.now(dt.timezone.utc)
    results = {"baseline_report": baseline_report(raw, spec=spec, generated_at=at), "correlation": correlation_long(raw, spec)}
    written = {}
    for name, df in results.items():
        T.write_snapshot(df, f"{out}/{name}")
        written[name] = spark.read.parquet(f"{out}/{name}")
        if mirror:
            T.write_mirror(written[name], f"{mirror}/{name}")
    return written
