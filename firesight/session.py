"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC session time zone so hour() and the
# ISO "Z" format mean UTC, and AQE so shuffle partitions are coalesced and
# skewed joins split at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The one-pass correlation aggregate holds ~110 buffer fields (21
    # co-moments, 7 variances); above the default 100 whole-stage codegen is
    # switched off for it, which halves its speed.
    "spark.sql.codegen.maxFields": "256",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "firesight", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("FIRESIGHT_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset in a
    local run a fresh scratch folder is made and set; on a cluster an unset
    folder is an error, as a machine's own folder isn't shared.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="firesight-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return spark.conf.get("spark.checkpoint.dir", None) or path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, *parts]) if parts else root


def unique_shared_path(spark: SparkSession, prefix: str) -> str:
    return shared_path(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")


def apply_base_conf(spark: SparkSession) -> None:
    """Apply the runtime settings a job relies on to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.ui"):
            continue
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
