"""The streaming queries (T1-T9, S1, S7 in streaming form).

* raw: source -> decode -> every readable reading into ``raw_readings``, before
  any filter, and every unreadable message into ``rejects``.
* enrichment: source -> decode -> outlier filter -> per-node stateful scoring
  (``transformWithStateInPandas``, RocksDB state store) -> ``foreachBatch``
  fan-out into keyed tables (enriched rows, fire events, alerts, counters,
  running totals, live node status). Every sink write replaces the
  partition of its own batch id, so a retried micro-batch leaves the tables as
  one clean run would. The running totals are state beside the scores' and come
  with the batch, so no table is read again for them; the sinks merge their
  tables' batches as they go (``sinks/keyed.py``).
* windows: source -> decode -> event time -> watermark -> tumbling window
  aggregate in update mode -> keyed upsert on (node, window_start).

Each query has its own checkpoint under the shared checkpoint folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firesight.functions.columns import clean, order_value, parse_ts
from firesight.operators.enrich import enrich_columns, finish, fire_events
from firesight.operators.rollups import enrichment_counts
from firesight.operators.status import coords_table, status_row
from firesight.operators.windows import flatten_window, window_aggs
from firesight.session import ensure_checkpoint_dir
from firesight.sinks import tables as T
from firesight.sources.envelope import decode, split_rejects
from firesight.spec import DEFAULT_SPEC, MAX_OFFSETS_PER_TRIGGER, ROLLUP_SENSORS, TRIGGER_INTERVAL, SensorSpec
from firesight.streaming.processor import PREV_FIRE, TOTALS, Enricher, scored_schema, totals_schema

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Partitions of a stream's state and of its sinks' exchanges, at most.
STREAM_PARTITIONS = 12


def configure_state_store(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB provider; set it before a first start. A batch commits what it changed
    (snapshots follow beside the stream), and a key isn't looked up again when it is written, only to count keys."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")


@contextmanager
def stream_partitions(spark: SparkSession) -> Iterator[None]:
    """A query that is started here has STREAM_PARTITIONS shuffle partitions at most. A session's number follows
    its tables; a micro-batch is bounded by its source, and pays every partition (a state store, a worker and
    a task of each of its sinks' jobs) however few rows it has. A checkpoint keeps the number it was begun with."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), STREAM_PARTITIONS)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# S1 ---------------------------------------------------------------------------
def read_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Messages as text lines from a folder of files (one JSON document per
    line), a bounded number of files per micro-batch."""
    return (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
            .text(path))


def read_kafka_stream(spark: SparkSession, servers: str, topic: str,
                      max_offsets: int = MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    """Messages from a topic (needs the Kafka connector on the class path):
    from the earliest offset, bounded offsets per trigger, tolerant of
    offsets lost to retention."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("failOnDataLoss", "false")
            .option("maxOffsetsPerTrigger", max_offsets)
            .load())


# T4 ---------------------------------------------------------------------------
def enrich_stream(decoded: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Filtered readings scored per node with state kept across micro-batches. Column TOTALS is
    null, but for the last row of each node in a micro-batch: there it has the node's running totals."""
    cleaned = clean(decoded, spec)
    names = spec.serving_names
    safe = cleaned.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in cleaned.columns])
    scored = (safe.groupBy("node_id")
              .transformWithStateInPandas(
                  statefulProcessor=Enricher(spec),
                  outputStructType=scored_schema(safe.schema, spec),
                  outputMode="Append",
                  timeMode="None"))
    zs = [f"zscore_{name}" for _, name, _ in spec.scored]
    totals = F.struct(*[F.col(f"{TOTALS}_{n}").alias(n) for n in totals_schema().fieldNames()])
    named = scored.select(*[F.col(names.get(c, c)).alias(c) for c in cleaned.columns], *zs, PREV_FIRE,
                          F.when(F.col(f"{TOTALS}_total_processed").isNotNull(), totals).alias(TOTALS))
    return finish(named, F.col(PREV_FIRE), spec).select(*cleaned.columns, *enrich_columns(spec), TOTALS)


# T9 ---------------------------------------------------------------------------
def deduplicated(decoded: DataFrame, delay: str) -> DataFrame:
    """Readings without repeats of a message (same node, index and time) within ``delay``, for use before anything
    that counts. What was seen is state by event time and goes once the watermark has passed it; a reading that
    comes later than the watermark is dropped, as a repeat of it couldn't be told. Readings without a
    readable time have no place in event time and pass unchecked.
    """
    timed = decoded.withColumn("_event", parse_ts(F.col("ingest_ts")).cast("timestamp"))
    # a null time is never below the watermark; with a key of their own these readings pass the same way as the
    # others, so the messages are read and parsed once
    told = F.when(F.col("_event").isNull(), F.uuid()).otherwise(F.col("ingest_ts"))
    return (timed.withColumn("_told", told).withWatermark("_event", delay)
            .dropDuplicatesWithinWatermark([*READING_KEY, "_told"]).drop("_event", "_told"))


def running_totals(batch: DataFrame) -> DataFrame:
    """A2: the running totals of the batch's nodes: a projection of each node's last row."""
    cols = [F.col(f"{TOTALS}.total_processed").alias("total_processed")]
    for _, suf, d, ds, _ in ROLLUP_SENSORS:
        cols += [F.round(F.col(f"{TOTALS}.sum_{suf}"), ds).alias(f"running_sum_{suf}"),
                 F.round(F.col(f"{TOTALS}.min_{suf}"), d).alias(f"running_min_{suf}"),
                 F.round(F.col(f"{TOTALS}.max_{suf}"), d).alias(f"running_max_{suf}")]
    return batch.filter(F.col(TOTALS).isNotNull()).select("*", *cols).drop(TOTALS)


READING_KEY = ["node_id", "reading_index"]
NODE_KEY = ["node_id"]


def live_status(spark: SparkSession, batch: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Status rows of the batch's nodes from their last enriched rows, which carry the running totals."""
    totals = running_totals(batch)
    return status_row(totals.drop(*[c for c in totals.columns if c.startswith("running_sum_")]), coords_table(spark, spec))


def _at_once(spark: SparkSession, sinks: list[Callable[[], None]]) -> None:
    """Run the sinks of a micro-batch beside each other, as each of their jobs has few tasks; all have ended
    when this returns or the first failure is raised."""
    with ThreadPoolExecutor(len(sinks)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(sink)) for sink in sinks]
    for sink in running:
        sink.result()


def fan_out(root: str, spec: SensorSpec = DEFAULT_SPEC, every: int = T.EVERY):
    """T5: one materialised micro-batch feeding several keyed tables, each merged after ``every`` batches."""
    def tables(spark: SparkSession, batch: DataFrame, batch_id: int) -> list[tuple]:
        rows = batch.drop(TOTALS)
        events = fire_events(rows)
        totals = running_totals(batch)
        running = totals.select("node_id", "total_processed", *[c for c in totals.columns if c.startswith("running_")])
        counters = enrichment_counts(rows.withColumn("stream_batch", F.lit(int(batch_id)).cast("long")), "stream_batch")
        return [(rows, "processed_readings", READING_KEY, order_value(rows)),
                (events, "fire_events", READING_KEY, order_value(events)),
                (T.alerts(events), "alerts", (), None),
                (running, "cumulative", NODE_KEY, None),
                (counters, "batch_counters", (), None),
                (live_status(spark, batch, spec), "node_status", NODE_KEY, None)]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            with ThreadPoolExecutor(1) as pool:
                # every partition of the state is updated here, once, before the sinks share the rows; their plans are
                # made meanwhile
                counted = pool.submit(inheritable_thread_target(spark)(batch.count))
                sinks = tables(spark, batch, batch_id)
                empty = not counted.result()  # as after each advance of the watermark
            _at_once(spark, [partial(T.store, df, f"{root}/{name}", batch_id, keys, order, every, empty)
                             for df, name, keys, order in sinks])
        finally:
            batch.unpersist()
    return run


def write_raw(root: str, every: int = T.EVERY):
    """The unfiltered batch into ``raw_readings``, what can't be read into ``rejects``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split_rejects(batch)
            T.store(good, f"{root}/raw_readings", batch_id, READING_KEY, order_value(good), every)
            T.store(bad, f"{root}/rejects", batch_id, every=every)
        finally:
            batch.unpersist()
    return run


def start_raw(spark: SparkSession, messages: DataFrame, root: str, checkpoint: str | None = None,
              trigger: dict | None = None, spec: SensorSpec = DEFAULT_SPEC, every: int = T.EVERY):
    """Start the raw query; returns the StreamingQuery."""
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark)}/streams/raw"
    with stream_partitions(spark):
        return (decode(messages, spec, keep_rejects=True).writeStream.foreachBatch(write_raw(root, every))
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL})).start())


def start_enrichment(spark: SparkSession, messages: DataFrame, root: str, checkpoint: str | None = None,
                     trigger: dict | None = None, spec: SensorSpec = DEFAULT_SPEC, every: int = T.EVERY,
                     dedup: str | None = None):
    """Start the enrichment query; returns the StreamingQuery. Its tables are merged after ``every`` batches.
    ``dedup``: a delay within which repeated messages are dropped before they are scored or counted."""
    configure_state_store(spark)
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark)}/streams/enrichment"
    decoded = decode(messages, spec)
    enriched = enrich_stream(deduplicated(decoded, dedup) if dedup else decoded, spec)
    with stream_partitions(spark):
        return (enriched.writeStream
                .foreachBatch(fan_out(root, spec, every))
                .option("checkpointLocation", checkpoint)
                .outputMode("append")
                .trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL}))
                .start())


WINDOW_KEY = ["node_id", "window_start"]


# T1-T3 ------------------------------------------------------------------------
def window_stream(decoded: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Tumbling window aggregate with watermark (late rows are dropped)."""
    ev = decoded.withColumn("event_ts", parse_ts(F.col("ingest_ts")).cast("timestamp"))
    return flatten_window(
        ev.withWatermark("event_ts", spec.watermark_delay)
        .groupBy(F.window("event_ts", spec.window_duration), F.col("node_id"))
        .agg(*window_aggs()))


def start_windows(spark: SparkSession, messages: DataFrame, root: str, checkpoint: str | None = None,
                  trigger: dict | None = None, every: int = T.EVERY):
    """Start the window query: update output, upserted on (node, window_start)."""
    configure_state_store(spark)
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark)}/streams/windows"
    agg = window_stream(decode(messages))
    with stream_partitions(spark):
        return (agg.writeStream
                .foreachBatch(lambda df, bid: T.store(df, f"{root}/window_stats", bid, WINDOW_KEY, every=every))
                .option("checkpointLocation", checkpoint)
                .outputMode("update")
                .trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL}))
                .start())


# W7 (streaming form) -----------------------------------------------------------
def read_stream_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The enrichment query's committed per-node state (count, mean, M2 per
    sensor and the last non-null fire value), read from its checkpoint with
    Spark's state store reader - one row per node, nothing kept elsewhere."""
    st = spark.read.format("statestore").option("stateVarName", "stats").load(checkpoint)
    return st.select("key.node_id", "value.*")


# T6 ---------------------------------------------------------------------------
def run_all(spark: SparkSession, source: str, root: str, max_files_per_trigger: int = 1,
            trigger: dict | None = None, wait: bool = True, checkpoint_root: str | None = None):
    """The three queries on the same source, each with its own reader and checkpoint.

    With ``wait`` the call returns when all have ended (``availableNow``) or
    raises when one fails; in either case no query is left running.
    """
    ck = checkpoint_root or f"{ensure_checkpoint_dir(spark)}/streams"
    starts = (("raw", start_raw), ("enrichment", start_enrichment), ("windows", start_windows))
    running = [start(spark, read_stream(spark, source, max_files_per_trigger), root,
                     checkpoint=f"{ck}/{name}", trigger=trigger) for name, start in starts]
    return wait_for(running) if wait else running


def wait_for(running: list) -> list:
    """Wait until every query has ended; the first failure stops the others and is raised."""
    try:
        waiting = list(running)
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(1)]
    finally:
        for q in running:
            q.stop()
    return running


def feed(start: Callable[[], StreamingQuery], sends: Iterable[Callable[[], None]]) -> None:
    """One run of a query over what each of ``sends`` adds to its source, all of one before the next is sent (with the
    batch that advances the watermark, if there is one). It starts after the first; a failure is raised."""
    query = None
    try:
        for send in sends:
            send()
            query = query or start()
            query.processAllAvailable()
    finally:
        if query:
            query.stop()


# T2 ---------------------------------------------------------------------------
PROGRESS = "query string, batch long, input_rows long, late_rows long, watermark string"


def store_progress(spark: SparkSession, queries: dict, root: str) -> None:
    """What each query's latest batches read and what its watermark dropped (rows of its state operators), as
    keyed table ``progress``. Spark keeps a bounded number of progress events, so call it in between on long runs;
    a batch that is stored again replaces itself. A query may report a batch twice; the last report counts."""
    rows = [(name, p["batchId"], p["numInputRows"], sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"]),
             (p.get("eventTime") or {}).get("watermark"))
            for name, query in queries.items() for p in map(_plain, query.recentProgress)]
    if rows:
        frame = spark.createDataFrame(rows, PROGRESS)
        known = T.batches_of(spark, f"{root}/progress")
        T.store(frame, f"{root}/progress", known, ["query", "batch"], F.col("input_rows").cast("decimal(38,0)"))


def _plain(progress) -> dict:
    return progress if isinstance(progress, dict) else json.loads(progress.json)


def read_tables(spark: SparkSession, root: str, names=None) -> dict[str, DataFrame]:
    """Current state of the stream outputs (merge-on-read of the keyed tables)."""
    def keyed(name, keys):
        return lambda: T.read_upserted(spark, f"{root}/{name}", keys)

    def appended(name):
        return lambda: T.read_batches(spark, f"{root}/{name}").drop(T.BATCH)

    readers = {
        "raw_readings": keyed("raw_readings", READING_KEY),
        "rejects": appended("rejects"),
        "processed_readings": keyed("processed_readings", READING_KEY),
        "fire_events": keyed("fire_events", READING_KEY),
        "alerts": appended("alerts"),
        "batch_counters": appended("batch_counters"),
        "node_status": keyed("node_status", NODE_KEY),
        "window_stats": keyed("window_stats", WINDOW_KEY),
        "cumulative": keyed("cumulative", NODE_KEY),
        "progress": keyed("progress", ["query", "batch"]),
    }
    return {n: readers[n]() for n in (names or readers)}
