"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the
whole test tables (the readings view over ``events``)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firesight.functions import columns as C
from firesight.functions.catalog import register_functions
from firesight.operators import baseline as B
from firesight.operators import correlate as K
from firesight.operators import rollups as R
from firesight.operators import serving as V
from firesight.operators import status as S
from firesight.operators.enrich import enrich, fire_events
from firesight.operators.quality import detection_quality
from firesight.operators.windows import window_stats
from firesight.session import unique_shared_path
from firesight.sinks import tables as T
from firesight.sources import csvfiles, envelope
from firesight.sources.readings import load_readings, read_table, readings_from_events, table_path
from firesight.spec import DEFAULT_SPEC, RETENTION, SENSOR_COLUMNS
from firesight.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

BATCH_EVERY = "1 hour"  # batch id of a replayed table: hour bucket of ingest_ts
CARD_NODE = "nodo_1"


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _raw(spark, sf):
    return load_readings(spark, sf)


def _clean(spark, sf):
    return C.clean(_raw(spark, sf))


def _enriched(spark, sf):
    return enrich(_raw(spark, sf))


def _served(spark, sf):
    """The enriched table's rows for queries that use no ordered column: the
    cleaned readings plus ``is_fire`` (a row-local flag) - the same rows and
    values, without sorting any node's history."""
    return _clean(spark, sf).withColumn("is_fire", C.is_fire(F.col("Fire")))


def _k(spark, sf):
    """Events with the props key parsed (used to derive test variants)."""
    ev = read_table(spark, table_path(sf, "events"))
    return ev.withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))


# --- baseline (A3-A6, J1-J3) ------------------------------------------------
@register("baseline_summary")
def q_baseline_summary(spark, sf):
    return B.baseline_summary(_raw(spark, sf))


@register("baseline_percentiles")
def q_baseline_percentiles(spark, sf):
    return B.baseline_percentiles(_raw(spark, sf))


@register("baseline_percentiles_exact")
def q_baseline_percentiles_exact(spark, sf):
    return B.baseline_percentiles_exact(_raw(spark, sf))


@register("hourly_trend")
def q_hourly_trend(spark, sf):
    return B.hourly_trend(_raw(spark, sf))


@register("hourly_trend_nested")
def q_hourly_trend_nested(spark, sf):
    """The nested trend, its array as JSON text."""
    return B.hourly_trend_nested(_raw(spark, sf)).withColumn("trend_hourly", B.trend_text(F.col("trend_hourly")))


@register("baseline_report")
def q_baseline_report(spark, sf):
    report = B.baseline_report(_raw(spark, sf))
    return report.withColumn("trend_hourly", B.trend_text(F.col("trend_hourly")))


@register("baseline_report_flat")
def q_baseline_report_flat(spark, sf):
    return B.baseline_report(_raw(spark, sf), nested=False)


@register("detection_quality")
def q_detection_quality(spark, sf):
    return detection_quality(_clean(spark, sf))


# --- correlation (A8-A10, A18) ---------------------------------------------
@register("sensor_correlation")
def q_sensor_correlation(spark, sf):
    return K.correlation_wide(_raw(spark, sf))


@register("correlation_pairs")
def q_correlation_pairs(spark, sf):
    return K.correlation_pairs(_raw(spark, sf))


@register("correlation_long")
def q_correlation_long(spark, sf):
    return K.correlation_long(_raw(spark, sf))


# --- ordered / keyed state (W1-W7) ------------------------------------------
@register("enriched_readings")
def q_enriched(spark, sf):
    return _enriched(spark, sf)


# Chunks so narrow that every node spans many, over readings with one flat sensor per node.
NARROW_CHUNK = 256
FLAT = {"nodo_1": ("Smoke (ppm)", 0.1), "nodo_2": ("Temperature (C)", 25.3), "nodo_3": ("CO", 0.07)}


def _multichunk(spark, sf):
    flat = _raw(spark, sf).withColumns({
        col: F.when(F.col("node_id") == node, F.lit(v)).otherwise(C.q(col)) for node, (col, v) in FLAT.items()})
    return enrich(flat, chunk_rows=NARROW_CHUNK)


@register("enriched_multichunk")
def q_enriched_multichunk(spark, sf):
    return _multichunk(spark, sf)


@register("fire_transitions_multichunk")
def q_fire_transitions_multichunk(spark, sf):
    return _multichunk(spark, sf).select("node_id", "reading_index", "Fire", "is_fire", "is_fire_transition",
                                         "fire_value_prev", "fire_state_label")


HOT_CHUNK = 1000


@register("enriched_hot_index")
def q_enriched_hot_index(spark, sf):
    """Half of every node's readings on one index: chunks are cut by the number of rows."""
    hot = _raw(spark, sf).withColumn("reading_index", F.when(F.col("reading_index") % 8 < 4, F.lit(5))
                                     .otherwise(F.col("reading_index")).cast("long"))
    return enrich(hot, chunk_rows=HOT_CHUNK, cuts="auto")


@register("nan_enriched")
def q_nan_enriched(spark, sf):
    """Readings that hold NaN values, cleaned as a stored table is when it is read, then enriched."""
    nan = F.lit(float("nan"))
    dirty = _raw(spark, sf).withColumns({
        "Temperature (C)": F.when(F.col("reading_index") % 7 == 0, nan).otherwise(C.q("Temperature (C)")),
        "Smoke (ppm)": F.when(F.col("reading_index") % 5 == 0, nan).otherwise(C.q("Smoke (ppm)")),
        "CO": F.when(F.col("reading_index") % 11 == 0, nan).otherwise(C.q("CO"))})
    return enrich(C.nan_to_null_all(dirty, SENSOR_COLUMNS))


@register("running_zscore")
def q_running_zscore(spark, sf):
    return _enriched(spark, sf).select("node_id", "reading_index", "zscore_Temperature", "zscore_CO",
                                       "zscore_Smoke", "zscore_Gas")


@register("anomaly_flags")
def q_anomaly_flags(spark, sf):
    return _enriched(spark, sf).select("node_id", "reading_index", "is_anomaly", "anomaly_sensors")


@register("fire_transitions")
def q_fire_transitions(spark, sf):
    return _enriched(spark, sf).select("node_id", "reading_index", "Fire", "is_fire", "is_fire_transition",
                                       "fire_value_prev", "fire_state_label")


@register("fire_events")
def q_fire_events(spark, sf):
    return fire_events(_enriched(spark, sf))


@register("latest_reading")
def q_latest_reading(spark, sf):
    return S.latest_reading(_raw(spark, sf))


@register("node_state")
def q_node_state(spark, sf):
    return S.node_state(_clean(spark, sf))


def _status(spark, sf):
    return S.node_status(_clean(spark, sf), S.coords_table(spark))


@register("node_status")
def q_node_status(spark, sf):
    return _status(spark, sf)


# --- roll-ups (A1, A2, A11, A16, A17) ---------------------------------------
def _batched(df):
    return df.withColumn("batch_id", R.batch_bucket(F.col("ingest_ts"), BATCH_EVERY))


@register("node_batch_stats")
def q_node_batch_stats(spark, sf):
    return R.node_batch_stats(_batched(_clean(spark, sf)))


@register("cumulative_stats")
def q_cumulative_stats(spark, sf):
    return R.cumulative_stats(_batched(_clean(spark, sf)))


@register("cumulative_by_batch")
def q_cumulative_by_batch(spark, sf):
    return R.cumulative_by_batch(R.node_batch_stats(_batched(_clean(spark, sf))))


@register("enrichment_counts")
def q_enrichment_counts(spark, sf):
    return R.enrichment_counts(_batched(_enriched(spark, sf)))


@register("fire_distribution")
def q_fire_distribution(spark, sf):
    return R.fire_distribution(_raw(spark, sf))


@register("snapshot_rollup")
def q_snapshot_rollup(spark, sf):
    return R.snapshot_rollup(B.baseline(_raw(spark, sf)))


# --- windows and serving (T1, A12-A15, J6, L1-L4, P12-P15) -------------------
@register("window_stats")
def q_window_stats(spark, sf):
    return window_stats(_raw(spark, sf))


@register("window_stats_hourly")
def q_window_stats_hourly(spark, sf):
    return window_stats(_raw(spark, sf), "1 hour")


@register("window_reagg")
def q_window_reagg(spark, sf):
    return V.window_reagg(window_stats(_raw(spark, sf)), "1 hour")


@register("sensor_histogram")
def q_sensor_histogram(spark, sf):
    return V.sensor_histogram(_served(spark, sf))


@register("topk_nodes")
def q_topk_nodes(spark, sf):
    return V.topk_nodes(V.sensor_histogram(_served(spark, sf)), k=2)


@register("anomaly_count")
def q_anomaly_count(spark, sf):
    clean = _clean(spark, sf)
    # the enriched rows are exactly the cleaned rows: same newest time
    return V.anomaly_count(enrich(_raw(spark, sf)), as_of=V.latest_time(clean))


@register("fire_activity")
def q_fire_activity(spark, sf):
    return V.fire_activity(_served(spark, sf))


@register("latest_anomalies")
def q_latest_anomalies(spark, sf):
    return V.latest_anomalies(_enriched(spark, sf)).select(
        "node_id", "reading_index", "ingest_ts", "anomaly_sensors", "zscore_Temperature", "CO")


@register("node_card")
def q_node_card(spark, sf):
    return V.node_card(_status(spark, sf), CARD_NODE)


@register("fire_cards")
def q_fire_cards(spark, sf):
    return V.fire_cards(_status(spark, sf))


@register("panel_projection")
def q_panel_projection(spark, sf):
    return V.panel_projection(_status(spark, sf))


@register("baseline_panel")
def q_baseline_panel(spark, sf):
    return V.sorted_panel(B.baseline(_raw(spark, sf)))


@register("baseline_panel_titled")
def q_baseline_panel_titled(spark, sf):
    return V.titled_panel(B.baseline(_raw(spark, sf)), V.BASELINE_PANEL_TITLES)


@register("coverage_panel")
def q_coverage_panel(spark, sf):
    return V.titled_panel(B.baseline_summary(_raw(spark, sf)), V.COVERAGE_PANEL_TITLES)


@register("quality_panel")
def q_quality_panel(spark, sf):
    return V.titled_panel(B.baseline_report(_raw(spark, sf), nested=False), V.QUALITY_PANEL_TITLES)


@register("report_bands")
def q_report_bands(spark, sf):
    return V.report_bands(B.baseline_report(_raw(spark, sf), nested=False), [p[0] for p in DEFAULT_SPEC.corr_pairs])


@register("status_bands")
def q_status_bands(spark, sf):
    recent = V.anomaly_count(_enriched(spark, sf), as_of=V.latest_time(_clean(spark, sf)))
    return V.status_bands(_status(spark, sf), recent)


@register("severity_bands")
def q_severity_bands(spark, sf):
    return V.severity_bands(_served(spark, sf))


@register("node_fire_rows")
def q_node_fire_rows(spark, sf):
    return V.node_fire_rows(_served(spark, sf), CARD_NODE)


# --- scalar column helpers (P1-P11) -----------------------------------------
@register("outlier_filter")
def q_outlier_filter(spark, sf):
    return _clean(spark, sf)


@register("fire_state_label")
def q_fire_state_label(spark, sf):
    return _raw(spark, sf).select("node_id", "reading_index", "Fire",
                                  C.fire_state_label(F.col("Fire")).alias("fire_state_label"),
                                  C.is_fire(F.col("Fire")).alias("is_fire"))


@register("threshold_flags")
def q_threshold_flags(spark, sf):
    return _raw(spark, sf).select("node_id", "reading_index",
                                  F.concat_ws(", ", C.threshold_flags()).alias("threshold_sensors"))


@register("fire_rule")
def q_fire_rule(spark, sf):
    return _raw(spark, sf).select("node_id", "reading_index", C.fire_rule().alias("fire_rule"))


@register("map_status")
def q_map_status(spark, sf):
    return _enriched(spark, sf).select("node_id", "reading_index",
                                       C.map_status(F.col("Fire"), F.col("is_anomaly")).alias("map_status"))


@register("sql_functions")
def q_sql_functions(spark, sf):
    """The scalar helpers called from SQL text."""
    register_functions(spark)
    return spark.sql("""
        SELECT node_id, reading_index, fire_state_label(Fire) AS fire_state_label, is_fire(Fire) AS is_fire,
               map_status(Fire, CO > 50) AS map_status, temperature_c_band(`Temperature (C)`) AS temp_band,
               co_band(CO) AS co_band, smoke_ppm_band(`Smoke (ppm)`) AS smoke_band, gas_ohm_band(`Gas (Ohm)`) AS gas_band
        FROM {readings}""", readings=_raw(spark, sf))


@register("ts_parse_format")
def q_ts_parse_format(spark, sf):
    return (_raw(spark, sf).select("node_id", "reading_index", C.iso_ts(F.col("ingest_ts")).alias("iso_text"))
            .withColumn("parsed_ts", C.parse_ts(F.col("iso_text")).cast("timestamp_ntz"))
            .withColumn("hour", C.hour_of_day(F.col("parsed_ts"))))


@register("nan_to_null")
def q_nan_to_null(spark, sf):
    ev = _k(spark, sf)
    temp = F.when(F.col("k") % 7 == 0, F.lit(float("nan"))).otherwise(F.lit(20.0) + F.col("value") / 10)
    return ev.select("event_id", C.nan_to_null(temp).alias("temperature_c"))


@register("labelled_only")
def q_labelled_only(spark, sf):
    return _raw(spark, sf).filter(F.col("Fire").isNotNull()).select("node_id", "reading_index", "Fire")


# --- sources and sinks (S2-S14) ---------------------------------------------
def _iso_readings(df):
    return df.withColumn("ingest_ts", C.iso_ts(F.col("ingest_ts")))


def _damaged(spark, sf):
    """Encoded readings as bytes, every message whose index ends in 13 cut short."""
    raw = _raw(spark, sf).withColumn("_cut", (F.col("reading_index") % 100) == 13)
    msgs = envelope.encode(raw, keep=["_cut"])
    damaged = msgs.select(
        "key", F.when(F.col("_cut"), F.substring("value", 1, 40)).otherwise(F.col("value"))
        .cast("binary").alias("value"))
    return damaged


@register("decode_envelope")
def q_decode_envelope(spark, sf):
    """What can be read of the damaged messages."""
    return envelope.decode(_damaged(spark, sf))


@register("decode_rejects")
def q_decode_rejects(spark, sf):
    """What can't: the message key and document of every reject."""
    bad = envelope.split_rejects(envelope.decode(_damaged(spark, sf), keep_rejects=True))[1]
    return bad.select("key", F.substring("document", 1, 19).alias("head"), F.length("document").alias("n_chars"))


@register("encode_decode_roundtrip")
def q_encode_decode_roundtrip(spark, sf):
    msgs = envelope.encode(_raw(spark, sf))
    return envelope.decode(msgs).select(F.col("node_id").alias("key"), "*")


JUNK_NUMBERS = ("nan", "1.0d", "1f", "0x10", "1_000", "-2.5e1")


@register("tolerant_cast")
def q_tolerant_cast(spark, sf):
    ev = _k(spark, sf)
    v = F.col("value").cast("string")
    value_text = (F.when(F.col("k") % 5 == 0, F.concat(F.lit(" "), v, F.lit(" ")))
                  .when(F.col("k") % 5 == 1, F.lit("abc"))
                  .when(F.col("k") % 5 == 2, F.lit(""))
                  .when(F.col("k") % 5 == 3, F.element_at(F.array(*map(F.lit, JUNK_NUMBERS)), (F.col("k") % 6 + 1).cast("int")))
                  .otherwise(v))
    fire_text = (F.when(F.col("k") % 4 == 0, F.when(F.col("k") % 8 == 0, F.lit(" 2 ")).otherwise(F.lit("\t2\t")))
                 .when(F.col("k") % 4 == 1, F.lit("1.0"))
                 .when(F.col("k") % 4 == 2, F.lit(""))
                 .otherwise(F.col("k").cast("string")))
    return ev.select("event_id", value_text.alias("value_text"), fire_text.alias("fire_text")).select(
        "event_id", "value_text", csvfiles.tolerant_double(F.col("value_text")).alias("value_parsed"),
        "fire_text", csvfiles.strict_int(F.col("fire_text")).alias("fire_parsed"))


@register("sequence_readings")
def q_sequence_readings(spark, sf):
    ev = read_table(spark, table_path(sf, "events"))
    nodes = ev.select(F.concat(F.lit("nodo_"), (F.col("user_id") % 4 + 1).cast("string")).alias("node_id"),
                      "event_id", "ts")
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    out = csvfiles.assign_index(nodes, "ts", chunk_width=3_600_000_000, base_ts=base, tie="event_id")
    return out.select("node_id", "event_id", "reading_index", "stamped_ts")


@register("sequence_hot_hour")
def q_sequence_hot_hour(spark, sf):
    """Half of the events within one hour, many at the same second: the index is a place in the sorted rows."""
    ev = read_table(spark, table_path(sf, "events"))
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    second = F.timestamp_add("SECOND", (F.col("event_id") % 1800).cast("long"), base)
    hot = F.when(F.col("event_id") % 2 == 0, second).otherwise(F.col("ts").cast("timestamp_ntz"))
    nodes = ev.select(F.concat(F.lit("nodo_"), (F.col("user_id") % 4 + 1).cast("string")).alias("node_id"),
                      "event_id", hot.alias("ts"))
    out = csvfiles.assign_index(nodes, "ts", base_ts=base, tie="event_id")
    return out.select("node_id", "event_id", "reading_index", "stamped_ts")


@register("upsert_latest")
def q_upsert_latest(spark, sf):
    """Two batches; the second updates half of the keys, each twice within the batch."""
    raw = readings_from_events(_k(spark, sf), keep=["k"])
    old = raw.withColumns({"batch": F.lit(0), "seq": F.lit(0)})
    changed = raw.filter(F.col("k") >= 50)
    first, second = (changed.withColumns({"Temperature (C)": C.q("Temperature (C)") + F.lit(by), "batch": F.lit(1),
                                          "seq": F.lit(n)}) for n, by in ((0, 5.0), (1, 1.0)))
    written = old.unionByName(second).unionByName(first).drop("k")
    return T.upsert_latest(written, ["node_id", "reading_index"], ["batch", "seq"]).drop("batch", "seq")


#: Micro-batches of ``upsert_many_batches``, and batches after which its sink merges.
MANY_BATCHES, MERGE_EVERY = 24, 5


@register("upsert_many_batches")
def q_upsert_many_batches(spark, sf):
    """Readings written in many batches, each with new readings and changes of the last batch's, by the sink
    that merges its table as it goes; then the table's state, from base, runs and batches."""
    target = unique_shared_path(spark, "upsert")
    raw = readings_from_events(_k(spark, sf), keep=["k"]).withColumn("b", F.coalesce("k", F.lit(0)) % MANY_BATCHES)
    path = unique_shared_path(spark, "upsert-input")
    raw.drop("k").write.partitionBy("b").parquet(path)  # by batch, so that a batch reads its own rows only
    rows = spark.read.schema(raw.drop("k").schema).parquet(path)
    for b in range(MANY_BATCHES):
        new = rows.filter(F.col("b") == b)
        changed = rows.filter(F.col("b") == b - 1).withColumn("Temperature (C)", C.q("Temperature (C)") + F.lit(float(b)))
        T.store(new.unionByName(changed).drop("b"), target, b, ["node_id", "reading_index"], every=MERGE_EVERY)
    return T.read_upserted(spark, target, ["node_id", "reading_index"])


@register("serving_projection")
def q_serving_projection(spark, sf):
    return T.to_serving(_enriched(spark, sf))


@register("retention_filter")
def q_retention_filter(spark, sf):
    return T.apply_retention(_raw(spark, sf), RETENTION["raw"])


@register("dedup_readings")
def q_dedup_readings(spark, sf):
    raw = _raw(spark, sf)
    again = raw.filter((F.col("reading_index") % 5) == 0)
    return T.dedup(raw.unionByName(again), ["node_id", "reading_index"])


@register("alert_feed")
def q_alert_feed(spark, sf):
    return T.alerts(fire_events(_enriched(spark, sf)))


@register("audit_counts")
def q_audit_counts(spark, sf):
    raw = _raw(spark, sf)
    enriched = enrich(raw)
    return T.audit_counts({
        "raw_readings": raw,
        "processed_readings": enriched,
        "fire_events": fire_events(enriched),
        "window_stats": window_stats(raw),
        "node_status": S.node_status(C.clean(raw), S.coords_table(spark)),
    })


# --- streams (S1, S7, T1-T9, W6, A11 in streaming form) -----------------------
STREAM_FILES = 4
#: Messages of a micro-batch and of a file, about; more messages are more micro-batches.
STREAM_ROWS, FILE_ROWS = 250_000, 100_000


def _streamed(spark, sf, name, which):
    """One stored table of the streams, after they have read the readings in parts by range of index
    (null first). A part is one micro-batch of about STREAM_ROWS messages at most (or of a quarter of few
    messages), in files of FILE_ROWS at most; the streams are stopped and started again after each."""
    raw = _iso_readings(_raw(spark, sf))
    n_parts = max(STREAM_FILES, -(-raw.count() // STREAM_ROWS))
    parts = envelope.encode(raw, keep=["reading_index"]).repartitionByRange(n_parts, F.col("reading_index").asc_nulls_first())
    return _sent(spark, parts.select("value", F.spark_partition_id().alias("part")), n_parts, name, which)


def _sent(spark, parts, n_parts, name, which, runs=None, **options):
    """The stored table after the messages of each part (``value``, ``part``) were sent as a micro-batch. The stream
    is stopped and started again after each part, or, with ``runs``, that many times in all."""
    root = unique_shared_path(spark, "stream")
    # written by part once, so that sending a part is a move of its folder
    parts.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("part").text(f"{root}/parts")
    written = set(T.names(spark, f"{root}/parts"))
    start = {"raw": jobs.start_raw, "enrichment": jobs.start_enrichment, "windows": jobs.start_windows}[which]

    def send(p):
        """All files of a part at once: they are one micro-batch, rows within it are ordered there, parts come in order."""
        if f"part={p}" in written:
            T.move(spark, f"{root}/parts/part={p}", f"{root}/messages-{p}")
        else:
            spark.createDataFrame([], "value string").write.text(f"{root}/messages-{p}")
        T.delete(spark, f"{root}/messages-{p - 2}")  # a restart looks at the last batch's files

    def started(trigger):
        return start(spark, jobs.read_stream(spark, f"{root}/messages-*", STREAM_ROWS), f"{root}/tables",
                     checkpoint=f"{root}/checkpoint", trigger=trigger, **options)

    if runs is None:
        for p in range(n_parts):
            send(p)
            jobs.wait_for([started({"availableNow": True})])
    else:
        for r in range(runs):
            jobs.feed(partial(started, {"processingTime": "0 seconds"}),
                      [partial(send, p) for p in range(r * n_parts // runs, (r + 1) * n_parts // runs)])
    return jobs.read_tables(spark, f"{root}/tables", [name])[name]


@register("stream_raw")
def q_stream_raw(spark, sf):
    return _streamed(spark, sf, "raw_readings", "raw")


@register("stream_enriched")
def q_stream_enriched(spark, sf):
    return _streamed(spark, sf, "processed_readings", "enrichment")


@register("stream_node_status")
def q_stream_node_status(spark, sf):
    return _streamed(spark, sf, "node_status", "enrichment")


@register("stream_window_stats")
def q_stream_window_stats(spark, sf):
    out = _streamed(spark, sf, "window_stats", "windows")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


#: Delay within which a repeated message is told.
DEDUP_DELAY = "2 days"


@register("stream_dedup")
def q_stream_dedup(spark, sf):
    """Every third message comes again a little later, partly in the next micro-batch: scores are as without it."""
    raw = _iso_readings(_raw(spark, sf)).withColumn("_pos", F.col("reading_index"))
    again = raw.filter(F.col("reading_index") % 3 == 0).withColumn("_pos", F.col("reading_index") + 41)
    n, least, most = raw.select(F.count("*"), F.min("_pos"), F.max("_pos")).first()
    parts = max(STREAM_FILES, -(-n // STREAM_ROWS))
    msgs = envelope.encode(raw.unionByName(again), keep=["_pos"])
    if n and 0 <= (least or 0) and (most or 0) < n:  # null last
        part = F.least(F.floor(F.col("_pos") * parts / n), F.lit(parts - 1)).cast("int")
    else:  # indexes with gaps: by rank, so that parts are alike in size wherever they lie
        msgs = msgs.repartitionByRange(parts, F.col("_pos").asc_nulls_last())
        part = F.spark_partition_id()
    return _sent(spark, msgs.select("value", part.alias("part")), parts, "processed_readings", "enrichment",
                 runs=STREAM_FILES, dedup=DEDUP_DELAY)


@register("stream_late_rows")
def q_stream_late_rows(spark, sf):
    """Windows over messages of which some come half a table late and some a few places: what the watermark
    admits is counted. A part's watermark is the newest time of the parts before it, less the delay."""
    raw = _iso_readings(_raw(spark, sf))
    n = raw.count()
    i = F.col("reading_index")
    pos = i + F.when(i % 20 == 7, F.lit(n // 2)).when(i % 20 == 9, F.lit(5)).otherwise(F.lit(0))
    part = F.floor(pos * 8 / (3 * n)).cast("int")
    msgs = envelope.encode(raw.withColumn("part", part), keep=["part"])
    out = _sent(spark, msgs.select("value", "part"), 4, "window_stats", "windows")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@register("stream_concurrent")
def q_stream_concurrent(spark, sf):
    """All three streams at once on one source: the rows of what each stored."""
    root = unique_shared_path(spark, "streams")
    msgs = envelope.encode(_iso_readings(_raw(spark, sf))).select("value")
    msgs.write.option("maxRecordsPerFile", FILE_ROWS).text(f"{root}/messages")
    jobs.run_all(spark, f"{root}/messages", f"{root}/tables", STREAM_ROWS, {"availableNow": True},
                 checkpoint_root=f"{root}/checkpoints")
    return T.audit_counts(jobs.read_tables(spark, f"{root}/tables", [
        "raw_readings", "rejects", "processed_readings", "window_stats", "node_status", "cumulative"]))


@register("csv_readings")
def q_csv_readings(spark, sf):
    """The readings as acquisition files: one folder per node, columns in another order for each, one without labels."""
    root = unique_shared_path(spark, "csv")
    raw = _raw(spark, sf).withColumn("_nth", F.substring("node_id", 6, 9).cast("int"))
    for nth in range(1, 5):
        columns = [*SENSOR_COLUMNS, "Fire"]
        turned = columns[nth:] + columns[:nth]
        mine = raw.filter(F.col("_nth") == nth).select(*[C.q(c) for c in turned if c != "Fire" or nth != 3])
        mine.write.option("header", "true").csv(f"{root}/nodo_{nth}")
    return csvfiles.read_csv_readings(spark, [f"{root}/nodo_{nth}" for nth in range(1, 5)])


@register("snapshot_report")
def q_snapshot_report(spark, sf):
    """A snapshot that replaces an older one."""
    path = unique_shared_path(spark, "snapshot") + "/report"
    report = B.baseline_percentiles(_raw(spark, sf))
    T.write_snapshot(report.limit(0), path)
    T.write_snapshot(report, path)
    return spark.read.parquet(path)


@register("mirror_report")
def q_mirror_report(spark, sf):
    """The second copy of a report, read back."""
    path = unique_shared_path(spark, "mirror")
    report = B.baseline_percentiles(_raw(spark, sf))
    T.write_mirror(report, path)
    return spark.read.schema(report.schema).json(path)


@register("stored_counts")
def q_stored_counts(spark, sf):
    """Rows of stored tables, from their files' footers."""
    root = unique_shared_path(spark, "stored")
    raw = _raw(spark, sf)
    tables = {"raw_readings": raw, "window_stats": window_stats(raw), "baseline": B.baseline_percentiles(raw)}
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
    return T.stored_counts(spark, {name: f"{root}/{name}" for name in tables})


@register("retention_purged")
def q_retention_purged(spark, sf):
    """Readings stored by day, days before the period removed, and what is left of the period read."""
    path = unique_shared_path(spark, "dated")
    raw = _raw(spark, sf)
    T.write_dated(raw, path)
    newest = raw.select(F.max("ingest_ts")).first()[0]
    T.purge(spark, path, RETENTION["raw"], newest)
    return T.read_retained(spark, path, RETENTION["raw"], newest).select(*raw.columns)


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


__all__ = ["queries", "REGISTRY", "DEFAULT_SPEC"]
