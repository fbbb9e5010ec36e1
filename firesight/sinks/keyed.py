"""Stored tables of the streams (S7): batch partitions, runs and a bucketed base, merged on read.

``target/deltas/batch_id=M``   what a micro-batch wrote; a replay replaces its own partition
``target/runs/...``            several batches merged into one sorted table, in levels
``target/base/...``            everything older, bucketed by key
``target/log/v=N``             which of these are live, one small file per version
``target/schema``              no rows: the columns, for a table that has none yet

A reader takes the newest version of the log and the batches after it. The newest row of each key among
batches and runs is found by one exchange of these rows alone; the base is bucketed by the key, so it is
joined to them bucket by bucket and never exchanged. A row without a batch that overwrote it comes from the base.

``maintain`` runs in the sink after every ``every`` batches: it merges them into a run of level 1, ``fan`` runs of
a level into one of the next, and all runs into a new base once they hold ``share`` of its rows. So the newer
part that a reader exchanges stays a bounded share of the table, and a row is rewritten a logarithmic number
of times. The new version is one file that appears at once: a failure before it leaves the table as it was.
What no live or previous version names is deleted, so readers of the previous version can finish.

Tables without keys are kept the same way, their rows only gathered.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BATCH = "batch_id"
#: A row's key as one text without nulls: what the base is bucketed and joined by.
KEY = "_merge_key"
#: Batches of a run, runs of a level that are merged, and the base's share of rows that runs may hold.
EVERY, FAN, SHARE = 16, 4, 0.25
#: Rows of a bucket, about; the number of buckets is a power of two, so it seldom changes.
BUCKET_ROWS = 1 << 18
LOG_SCHEMA = "kind string, path string, level int, last long, rows long, buckets int"


@dataclass(frozen=True)
class Part:
    """A live run (level 1 and up) or the base (level 0); ``last``: its newest batch."""
    path: str
    level: int
    last: int
    rows: int
    buckets: int = 0


@dataclass
class Live:
    """A version of the log: batches up to ``covered`` are in the base or the runs."""
    version: int = 0
    covered: int = -1
    base: Part | None = None
    runs: list[Part] = field(default_factory=list)

    @property
    def paths(self) -> set[str]:
        return {p.path for p in (*self.runs, *([self.base] if self.base else []))}


def move(spark: SparkSession, path: str, to: str) -> None:
    fs, hadoop = _folder(spark, path)
    if not fs.rename(hadoop, _folder(spark, to)[1]):
        raise OSError(f"can't move {path} to {to}")


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def names(spark: SparkSession, path: str) -> list[str]:
    """Entries of a folder, none if it doesn't exist."""
    fs, hadoop = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _folder(spark, path)
    fs.delete(hadoop, True)


def versions(spark: SparkSession, target: str) -> list[Live]:
    """The versions that the log holds, oldest first."""
    try:
        rows = spark.read.schema(f"{LOG_SCHEMA}, v int").json(f"{target}/log").collect()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found: dict[int, Live] = {}
    for r in rows:  # the parts of a table are few: runs per level, times levels
        live = found.setdefault(r.v, Live(r.v))
        if r.kind == "covered":
            live.covered = r["last"]
        else:
            part = Part(f"{target}/{r.path}", r.level, r["last"], r.rows, r.buckets)
            if r.kind == "base":
                live.base = part
            else:
                live.runs.append(part)
    for live in found.values():
        live.runs.sort(key=lambda p: p.last)
    return [found[v] for v in sorted(found)]


def live(spark: SparkSession, target: str) -> Live:
    return (versions(spark, target) or [Live()])[-1]


def _commit(spark: SparkSession, target: str, new: Live) -> None:
    rows = [("covered", None, 0, new.covered, 0, 0)]
    rows += [(kind, p.path.removeprefix(f"{target}/"), p.level, p.last, p.rows, p.buckets)
             for kind, parts in (("run", new.runs), ("base", [new.base] if new.base else [])) for p in parts]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{target}/log/v={new.version}")


# Writing ------------------------------------------------------------------------
def write_batch(df: DataFrame, target: str, batch_id: int, keys: Sequence[str] = (), order: Column | None = None) -> None:
    """Write one micro-batch to ``target`` as partition ``batch_id``.

    With ``keys``, only the last row of each key by ``order`` is written (equal
    orders: by the row's values, so that a retry picks the same): one exchange, before
    which a task's rows are already down to one per key.
    Overwrites only its partition, so a retried batch replaces its own earlier
    attempt and nothing else. The ``rebalance`` hint lets AQE size the output
    files (a micro-batch would otherwise write one small file per state partition).
    """
    if keys:
        values = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c not in keys])
        by = [] if order is None else [order.desc_nulls_last()]
        place = F.row_number().over(Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*by, values.desc()))
        df = df.withColumn("_n", place).filter("_n = 1").drop("_n")
    df = df.withColumn(BATCH, F.lit(int(batch_id)).cast("long"))
    if not names(df.sparkSession, f"{target}/schema"):
        df.limit(0).write.mode("overwrite").parquet(f"{target}/schema")
    (df.hint("rebalance")
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(BATCH)
       .parquet(f"{target}/deltas"))


def store(df: DataFrame, target: str, batch_id: int, keys: Sequence[str] = (), order: Column | None = None,
          every: int = EVERY, empty: bool = False) -> None:
    """``write_batch``, and after every ``every`` batches ``maintain``: the form a running sink uses.
    ``empty``: the batch is known to have no rows, so only a table that has no columns yet is written."""
    if not empty or not names(df.sparkSession, f"{target}/schema"):
        write_batch(df, target, batch_id, keys, order)
    if (batch_id + 1) % every == 0:
        maintain(df.sparkSession, target, keys, batch_id)


# Reading ------------------------------------------------------------------------
def _batches(spark: SparkSession, target: str, after: int) -> list[int]:
    return sorted(b for b in (int(n.split("=")[1]) for n in names(spark, f"{target}/deltas") if n.startswith(f"{BATCH}="))
                  if b > after)


def batches_of(spark: SparkSession, target: str) -> int:
    """The number after the newest batch of a table, for writers that number their batches themselves."""
    known = _batches(spark, target, -1)
    return max([live(spark, target).covered, *known]) + 1


def _deltas(spark: SparkSession, target: str, batches: list[int]) -> DataFrame | None:
    if not batches:
        return None
    rows = spark.read.option("basePath", f"{target}/deltas").parquet(*[f"{target}/deltas/{BATCH}={b}" for b in batches])
    return rows.withColumn(BATCH, F.col(BATCH).cast("long"))


def _keyed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not keys:
        return rows
    return rows.withColumn(KEY, F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]), {"ignoreNullFields": "false"}))


def _base(spark: SparkSession, part: Part) -> DataFrame:
    """The base as a bucketed table; its folder and buckets come from the log, so any session can read it."""
    if not part.buckets:  # of a table without keys
        return spark.read.parquet(part.path)
    name = "firesight_base_" + part.path.rstrip("/").rsplit("/", 1)[-1]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(part.path).schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                  f"INTO {part.buckets} BUCKETS LOCATION '{part.path}'")
    return spark.table(name)


def _newer(spark: SparkSession, target: str, keys: Sequence[str], at: Live, batches: list[int]) -> DataFrame | None:
    parts = [spark.read.parquet(p.path) for p in at.runs]
    deltas = _deltas(spark, target, batches)
    if deltas is not None:
        parts.append(_keyed(deltas, keys))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def _newest(rows: DataFrame, buckets: int | None = None) -> DataFrame:
    """The row of the newest batch of each key: one exchange, into the base's buckets if there is one."""
    dealt = rows.repartition(buckets, KEY) if buckets else rows
    place = F.row_number().over(Window.partitionBy(KEY).orderBy(F.desc(BATCH)))
    return dealt.withColumn("_n", place).filter("_n = 1").drop("_n")


def _merged(base: DataFrame | None, buckets: int | None, newer: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows with KEY and BATCH: the newest of each key, or all rows of a table without keys."""
    if base is None or newer is None:
        rows = newer if base is None else base
        return _newest(rows, buckets) if keys and base is None else rows
    if not keys:
        return base.unionByName(newer, allowMissingColumns=True)
    top = _newest(newer, buckets)
    # a bucket's newer keys are a bounded share of its rows: hashed, so that the base isn't sorted either
    old = base.join(top.select(KEY).hint("shuffle_hash"), KEY, "left_anti")
    return old.unionByName(top, allowMissingColumns=True)


def _table(spark: SparkSession, target: str, keys: Sequence[str], at: Live, batches: list[int],
           buckets: int | None = None) -> DataFrame:
    """``buckets``: where the newer rows meet if there is no base."""
    base = _base(spark, at.base) if at.base else None
    return _merged(base, at.base.buckets if at.base else buckets, _newer(spark, target, keys, at, batches), keys)


def read_upserted(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """Current state of a keyed table: the row of the newest batch per key."""
    at = live(spark, target)
    batches = _batches(spark, target, at.covered)
    if at.base is None and not at.runs and not batches:
        return spark.read.parquet(f"{target}/schema").drop(BATCH)
    return _table(spark, target, keys, at, batches).drop(KEY, BATCH)


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    """All stored rows with the batch they came from (merged rows: the batch that wrote them last)."""
    at = live(spark, target)
    parts = [spark.read.parquet(p) for p in sorted(at.paths)]
    deltas = _deltas(spark, target, _batches(spark, target, at.covered))
    if deltas is not None:
        parts.append(deltas)
    if not parts:
        return spark.read.parquet(f"{target}/schema")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.drop(KEY) for p in parts])


# Compaction -----------------------------------------------------------------------
def _write_run(spark: SparkSession, rows: DataFrame, target: str, level: int, last: int) -> Part:
    path = f"{target}/runs/{uuid.uuid4().hex}"
    # keyed rows come in the partitions of ``_newest``
    (rows.sortWithinPartitions(KEY, BATCH) if KEY in rows.columns else rows.hint("rebalance")).write.parquet(path)
    return Part(path, level, last, spark.read.parquet(path).count())


def _buckets(rows: int, bucket_rows: int) -> int:
    buckets = 1
    while buckets * bucket_rows < rows:
        buckets *= 2
    return buckets


def _write_base(spark: SparkSession, rows: DataFrame, target: str, last: int, most: int, bucket_rows: int) -> Part:
    name = uuid.uuid4().hex
    path = f"{target}/base/{name}"
    if KEY not in rows.columns:
        rows.hint("rebalance").write.parquet(path)
        return Part(path, 0, last, spark.read.parquet(path).count())
    buckets = _buckets(most, bucket_rows)
    # the rows come in the partitions of ``_merged``, by key in a power of two no larger than ``buckets``: each writes
    # buckets of its own, once the old rows and once the newer ones, without another exchange
    rows.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(f"firesight_base_{name}")
    return Part(path, 0, last, spark.read.parquet(path).count(), buckets)


def maintain(spark: SparkSession, target: str, keys: Sequence[str], upto: int | None = None, fan: int = FAN,
             share: float = SHARE, bucket_rows: int = BUCKET_ROWS, full: bool = False) -> int:
    """Merge the batches up to ``upto`` (all) into the levels; returns the new version. ``full``: into the base."""
    known = versions(spark, target)
    at = known[-1] if known else Live()
    batches = [b for b in _batches(spark, target, at.covered) if upto is None or b <= upto]
    new = Live(at.version + 1, max([at.covered, *batches]), at.base, list(at.runs))
    fresh = _newer(spark, target, keys, Live(), batches)
    old = at.base.rows if at.base else 0
    n_fresh = fresh.count() if batches else 0  # from the files' footers
    held = sum(p.rows for p in at.runs) + n_fresh
    # exchanges follow the rows they merge: a sink's session has a micro-batch's few partitions, without AQE
    if held and (full or held >= share * old):
        merged = _table(spark, target, keys, at, batches, _buckets(held, bucket_rows))
        new.base, new.runs = _write_base(spark, merged, target, new.covered, held + old, bucket_rows), []
    elif batches:
        new.runs.append(_write_run(spark, _newest(fresh, _buckets(n_fresh, bucket_rows)) if keys else fresh, target, 1, batches[-1]))
    level = 1
    while (same := [p for p in new.runs if p.level == level]) and level < 64:
        if len(same) >= fan:
            rows = _newer(spark, target, keys, Live(runs=same), [])
            n = _buckets(sum(p.rows for p in same), bucket_rows)
            run = _write_run(spark, _newest(rows, n) if keys else rows, target, level + 1, same[-1].last)
            new.runs = sorted([p for p in new.runs if p.level != level] + [run], key=lambda p: p.last)
        level += 1
    _commit(spark, target, new)
    _clean(spark, target, [at, new])
    return new.version


def _clean(spark: SparkSession, target: str, kept: list[Live]) -> None:
    """Delete what only older versions name: a table has one writer, and readers may be one version late."""
    paths = set().union(*(k.paths for k in kept))
    for kind in ("runs", "base"):
        for name in names(spark, f"{target}/{kind}"):
            if f"{target}/{kind}/{name}" not in paths:
                spark.sql(f"DROP TABLE IF EXISTS firesight_base_{name}")
                delete(spark, f"{target}/{kind}/{name}")
    for name in names(spark, f"{target}/deltas"):
        if name.startswith(f"{BATCH}=") and int(name.split("=")[1]) <= kept[0].covered:
            delete(spark, f"{target}/deltas/{name}")
    for name in names(spark, f"{target}/log"):
        if name.startswith("v=") and int(name.split("=")[1]) < kept[0].version:
            delete(spark, f"{target}/log/{name}")


def compact(spark: SparkSession, target: str, keys: Sequence[str]) -> int:
    """Merge everything into a new base; returns the new version."""
    return maintain(spark, target, keys, full=True)
