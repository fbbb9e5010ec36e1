"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on DuckDB with the test tables registered as views. It
recomputes the query from the definitions in plain SQL (naive windows, no
prefix scan), so it checks the Spark plans independently.

Rounding recipe: Spark rounds half-up on the decimal text of a double, DuckDB
on the binary value; ``R(x, n)`` rounds through the decimal text too, and
``+ 0.0e0`` folds -0.0 into 0.0.
"""

from __future__ import annotations

from itertools import combinations

from firesight.spec import CORR_PAIRS, CORR_SENSORS, NODE_COORDS
from firesight.spec import SHORT_NAMES as SHORT


def R(expr: str, n: int) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def RA(col: str, n: int) -> str:
    """Exact average of ``col`` rounded half-up (away from zero) to n decimals:
    decimal sum scaled to an integer, rounded by integer division."""
    s_ = f"CAST(sum(CAST({col} AS DECIMAL(38,12))) * 1000000000000 AS HUGEINT)"
    d_ = f"(CAST(count({col}) AS HUGEINT) * 1000000000000)"
    q_ = f"((2 * abs({s_}) * {10 ** n} + {d_}) // (2 * {d_}))"
    return f"CASE WHEN count({col}) = 0 THEN NULL ELSE CAST(sign({s_}) * {q_} AS DOUBLE) / {10 ** n}.0e0 END"


def RS(expr: str, digits: int) -> str:
    """Round to significant digits, the same steps as round_significant."""
    scale = f"pow(10.0e0, floor(log10(abs({expr}))))"
    return f"CASE WHEN ({expr}) = 0 THEN 0.0e0 ELSE {R(f'({expr}) / {scale}', digits - 1)} * {scale} END"


def Q(name: str) -> str:
    return '"' + name + '"'


READINGS = """
ev AS (
  SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
readings AS (
  SELECT
    CAST(CASE WHEN k = 0 THEN NULL ELSE 20.0e0 + value / 10 END AS DOUBLE) AS "Temperature (C)",
    CAST(40.0e0 + event_id % 37 AS DOUBLE) AS "Humidity (%)",
    CAST(1000.0e0 + user_id % 23 AS DOUBLE) AS "Pressure (hPA)",
    CAST(CASE WHEN event_type = 'signup' AND k >= 97 THEN 1200000.0e0
              ELSE 200000.0e0 - value * 600 END AS DOUBLE) AS "Gas (Ohm)",
    CAST(NULL AS DOUBLE) AS "Visible Light",
    CAST(NULL AS DOUBLE) AS "IR",
    CAST(NULL AS DOUBLE) AS "UV index",
    CAST(CASE WHEN event_type = 'error' THEN value * 3 ELSE value / 10 END AS DOUBLE) AS "CO",
    CAST(value * k / 1000 AS DOUBLE) AS "NO2",
    CAST(k / 1000.0e0 AS DOUBLE) AS "Smoke (ppm)",
    CAST(CASE WHEN user_id % 4 = 3 THEN NULL
              WHEN event_type = 'purchase' THEN 1
              WHEN event_type = 'error' AND k >= 90 THEN 2
              ELSE 0 END AS INTEGER) AS "Fire",
    'nodo_' || CAST(user_id % 4 + 1 AS VARCHAR) AS node_id,
    CAST(event_id AS BIGINT) AS reading_index,
    ts AS ingest_ts
  FROM ev
)"""

CLEAN = """
clean AS (
  SELECT * FROM readings WHERE "CO" < 1000.0e0 AND "Gas (Ohm)" < 1000000.0e0
)"""

RAW_COLS = ('"Temperature (C)", "Humidity (%)", "Pressure (hPA)", "Gas (Ohm)", "Visible Light", "IR", '
            '"UV index", "CO", "NO2", "Smoke (ppm)", "Fire", node_id, reading_index, ingest_ts')

SCORED = (("Temperature (C)", "Temperature"), ("CO", "CO"), ("Smoke (ppm)", "Smoke"), ("Gas (Ohm)", "Gas"))
THRESH = (("CO", "CO", ">", "50.0e0"), ("Smoke", "Smoke (ppm)", ">", "0.08e0"),
          ("Temperature", "Temperature (C)", ">", "35.0e0"), ("Gas", "Gas (Ohm)", "<", "5000.0e0"))
WIN = "PARTITION BY node_id ORDER BY coalesce(reading_index, 0), ingest_ts"


def _z(col: str) -> str:
    x = Q(col)
    w = "OVER w"
    return (f"CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN count({x}) {w} > 1 AND min({x}) {w} < max({x}) {w} AND var_pop({x}) {w} > 0 "
            f"THEN {R(f'({x} - avg({x}) {w}) / stddev_samp({x}) {w}', 3)} + 0.0e0 ELSE 0.0e0 END")


def _flags_expr() -> tuple[str, str]:
    zf = {name: f"(abs(coalesce(zscore_{name}, 0.0e0)) > 2.0e0)" for _, name in SCORED}
    parts = [f"CASE WHEN {zf[name]} THEN '{name}' END" for _, name in SCORED]
    for name, col, op, thr in THRESH:
        parts.append(f"CASE WHEN coalesce({Q(col)} {op} {thr}, false) AND NOT {zf[name]} THEN '{name}' END")
    joined = "concat_ws(', ', " + ", ".join(parts) + ")"
    return joined, f"({joined}) <> ''"


LABEL = ("CASE WHEN \"Fire\" IS NULL THEN 'N/A' WHEN \"Fire\" = 0 THEN 'NORMAL' "
         "WHEN \"Fire\" = 1 THEN 'FIRE' ELSE 'SPECIAL' END")
IS_FIRE = "coalesce(\"Fire\" >= 1, false)"


def _enriched_cte() -> str:
    zs = ",\n    ".join(f"{_z(col)} AS zscore_{name}" for col, name in SCORED)
    joined, anomalous = _flags_expr()
    return f"""
scored AS (
  SELECT {RAW_COLS},
    {zs},
    last_value("Fire" IGNORE NULLS) OVER ({WIN} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_fire
  FROM clean
  WINDOW w AS ({WIN} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
enriched AS (
  SELECT {RAW_COLS},
    zscore_Temperature, zscore_CO, zscore_Smoke, zscore_Gas,
    {anomalous} AS is_anomaly,
    {joined} AS anomaly_sensors,
    {IS_FIRE} AS is_fire,
    coalesce("Fire" >= 1 AND (prev_fire IS NULL OR prev_fire = 0), false) AS is_fire_transition,
    CAST(coalesce(prev_fire, 0) AS INTEGER) AS fire_value_prev,
    {LABEL} AS fire_state_label
  FROM scored
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BASE = with_(READINGS)
BASE_CLEAN = with_(READINGS, CLEAN)
BASE_ENRICHED = with_(READINGS, CLEAN, _enriched_cte())

SUFFIX = {"Temperature (C)": "temp", "CO": "co", "Smoke (ppm)": "smoke", "Gas (Ohm)": "gas"}


def _summary_cols() -> str:
    cols = ["count(*) AS total_readings", "count(DISTINCT reading_index) AS distinct_reading_index",
            "min(ingest_ts) AS first_ingest_ts", "max(ingest_ts) AS last_ingest_ts"]
    for col, suf in SUFFIX.items():
        cols += [f"{RA(Q(col), 4)} AS avg_{suf}", f"{R(f'min({Q(col)})', 4)} AS min_{suf}",
                 f"{R(f'max({Q(col)})', 4)} AS max_{suf}"]
    return ", ".join(cols)


def _pct_cols() -> str:
    cols = []
    for col, suf in SUFFIX.items():
        for p, n in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
            cols.append(f"{R(f'quantile_disc({Q(col)}, {p})', 4)} AS {n}_{suf}")
    return ", ".join(cols)


def _corr(a: str, b: str) -> str:
    den = f"(stddev_pop({Q(a)}) * stddev_pop({Q(b)}))"
    return f"CASE WHEN {den} = 0 THEN NULL ELSE {R(f'covar_pop({Q(a)}, {Q(b)}) / {den}', 4)} END"


def _corr_wide_cte() -> str:
    complete = " AND ".join(f"{Q(s)} IS NOT NULL AND NOT isnan({Q(s)})" for s in CORR_SENSORS)
    pairs = ",\n    ".join(f"{_corr(a, b)} AS corr_{SHORT[a]}_{SHORT[b]}" for a, b in combinations(CORR_SENSORS, 2))
    return f"""
corr_wide AS (
  SELECT CASE WHEN grouping(node_id) = 1 THEN 'global' ELSE node_id END AS scope,
    count(*) AS n_rows,
    {pairs}
  FROM readings WHERE {complete}
  GROUP BY GROUPING SETS ((node_id), ())
)"""


def _pairs_select() -> str:
    idx = {s: i for i, s in enumerate(CORR_SENSORS)}
    cols = []
    for label, a, b in CORR_PAIRS:
        x, y = (a, b) if idx[a] < idx[b] else (b, a)
        cols.append(f"corr_{SHORT[x]}_{SHORT[y]} AS {label}")
    return ", ".join(cols)


def _long_select() -> str:
    parts = []
    for a, b in combinations(CORR_SENSORS, 2):
        col = f"corr_{SHORT[a]}_{SHORT[b]}"
        parts.append(f"SELECT scope, '{a}' AS sensor_a, '{b}' AS sensor_b, {col} AS correlation FROM corr_wide")
        parts.append(f"SELECT scope, '{b}' AS sensor_a, '{a}' AS sensor_b, {col} AS correlation FROM corr_wide")
    for s in CORR_SENSORS:
        parts.append(f"SELECT scope, '{s}' AS sensor_a, '{s}' AS sensor_b, 1.0e0 AS correlation FROM corr_wide")
    return "\nUNION ALL ".join(parts)


def _fire_rule() -> str:
    return " OR ".join(f"coalesce({Q(col)} {op} {thr}, false)" for _, col, op, thr in THRESH)


QUALITY_CTE = f"""
qc AS (
  SELECT node_id,
    CAST(count_if("Fire" >= 1 AND ({_fire_rule()})) AS BIGINT) AS tp,
    CAST(count_if(NOT ("Fire" >= 1) AND ({_fire_rule()})) AS BIGINT) AS fp,
    CAST(count_if(NOT ("Fire" >= 1) AND NOT ({_fire_rule()})) AS BIGINT) AS tn,
    CAST(count_if("Fire" >= 1 AND NOT ({_fire_rule()})) AS BIGINT) AS fn
  FROM clean WHERE "Fire" IS NOT NULL GROUP BY node_id
),
qr AS (
  SELECT *,
    CASE WHEN tp + fp = 0 THEN 0.0e0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p_,
    CASE WHEN tp + fn = 0 THEN 0.0e0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS r_,
    CASE WHEN tp + fp + tn + fn = 0 THEN 0.0e0 ELSE CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn) END AS a_
  FROM qc
),
quality AS (
  SELECT node_id, tp, fp, tn, fn, {R('p_', 4)} AS precision, {R('r_', 4)} AS recall,
    {R('CASE WHEN p_ + r_ = 0 THEN 0.0e0 ELSE 2.0e0 * p_ * r_ / (p_ + r_) END', 4)} AS f1,
    {R('a_', 4)} AS accuracy
  FROM qr
)"""

ROLL = (("Temperature (C)", "temp", 2, 4), ("CO", "co", 2, 4), ("Smoke (ppm)", "smoke", 4, 4),
        ("Gas (Ohm)", "gas", 2, 2))

STATUS_CTE = """
latest AS (
  SELECT * FROM enriched
  QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY coalesce(reading_index, 0) DESC, ingest_ts DESC) = 1
),
cum AS (
  SELECT node_id, count(*) AS total_processed, {cum_cols} FROM enriched GROUP BY node_id
),
coords(node_id, lat, lon) AS (VALUES {coords}),
status AS (
  SELECT l.node_id, l.ingest_ts AS last_ingest_ts, l."Temperature (C)" AS temperature_c,
    l."Humidity (%)" AS humidity_pct, l."Pressure (hPA)" AS pressure_hpa, l."Gas (Ohm)" AS gas_ohm,
    l."CO" AS co, l."Smoke (ppm)" AS smoke_ppm, l."Fire" AS fire, coalesce(l."Fire" >= 1, false) AS is_fire,
    l.fire_state_label, l.is_anomaly AS is_anomaly_current, l.anomaly_sensors,
    l.zscore_Temperature, l.zscore_CO, l.zscore_Smoke, l.zscore_Gas,
    c.running_min_temp, c.running_max_temp, c.running_min_co, c.running_max_co,
    c.running_min_smoke, c.running_max_smoke, c.running_min_gas, c.running_max_gas,
    c.total_processed, l.ingest_ts AS last_update_ts, d.lat, d.lon,
    CASE WHEN coalesce(l."Fire" >= 1, false) THEN 2 WHEN coalesce(l.is_anomaly, false) THEN 1 ELSE 0 END
      AS map_status
  FROM latest l LEFT JOIN cum c USING (node_id) LEFT JOIN coords d USING (node_id)
)""".format(
    cum_cols=", ".join(f"{R(f'min({Q(c)})', d)} AS running_min_{s}, {R(f'max({Q(c)})', d)} AS running_max_{s}"
                       for c, s, d, _ in ROLL),
    coords=", ".join(f"('{k}', {v[0]!r}e0, {v[1]!r}e0)" for k, v in sorted(NODE_COORDS.items())),
)

BASE_STATUS = with_(READINGS, CLEAN, _enriched_cte(), STATUS_CTE)

BATCHED = "time_bucket(INTERVAL '1 hour', ingest_ts) AS batch_id"


def _batch_stats_cols() -> str:
    cols = ["count(*) AS batch_count"]
    for c, s, d, ds in ROLL:
        cols += [f"{RA(Q(c), d)} AS batch_avg_{s}", f"{R(f'min({Q(c)})', d)} AS batch_min_{s}",
                 f"{R(f'max({Q(c)})', d)} AS batch_max_{s}", f"{R(f'sum({Q(c)})', ds)} AS batch_sum_{s}"]
    return ", ".join(cols)


def _window_cols() -> str:
    return (f"{RA(Q('Temperature (C)'), 2)} AS avg_temp, {R('max(\"Temperature (C)\")', 2)} AS max_temp, "
            f"{RA(Q('CO'), 2)} AS avg_co, {R('max(\"CO\")', 2)} AS max_co, "
            f"{RA(Q('Smoke (ppm)'), 4)} AS avg_smoke, {R('max(\"Smoke (ppm)\")', 4)} AS max_smoke, "
            f"{RA(Q('Gas (Ohm)'), 2)} AS avg_gas, {R('min(\"Gas (Ohm)\")', 2)} AS min_gas, "
            "count(*) AS reading_count")


def _window_sql(every: str) -> str:
    return (f"SELECT time_bucket(INTERVAL '{every}', ingest_ts) AS window_start, "
            f"time_bucket(INTERVAL '{every}', ingest_ts) + INTERVAL '{every}' AS window_end, node_id, "
            f"{_window_cols()} FROM readings WHERE ingest_ts IS NOT NULL GROUP BY 1, 2, 3")


def _band(col: str, steps) -> str:
    expr = "0"
    for i, s in enumerate(steps, start=1):
        expr = f"CASE WHEN {col} >= {float(s)!r}e0 THEN {i} ELSE {expr} END"
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE {expr} END"


ORACLES: dict[str, str] = {}

ORACLES["baseline_summary"] = f"{BASE} SELECT node_id, {_summary_cols()} FROM readings GROUP BY node_id"
ORACLES["baseline_percentiles"] = f"{BASE} SELECT node_id, {_pct_cols()} FROM readings GROUP BY node_id"
ORACLES["baseline_percentiles_exact"] = ORACLES["baseline_percentiles"]
ORACLES["hourly_trend"] = (f"{BASE} SELECT node_id, CAST(hour(ingest_ts) AS INTEGER) AS hour, "
                           f"{RA(Q('Temperature (C)'), 4)} AS avg_temp FROM readings "
                           "WHERE hour(ingest_ts) IS NOT NULL GROUP BY 1, 2")
TREND = f"""
th AS (SELECT node_id, hour(ingest_ts) AS hour, {RA(Q('Temperature (C)'), 4)} AS avg_temp FROM readings
  WHERE hour(ingest_ts) IS NOT NULL GROUP BY 1, 2),
trend AS (SELECT node_id, '[' || string_agg('{{"hour":' || hour || ',"avg_temp":' || coalesce(CAST(avg_temp AS VARCHAR), 'null')
  || '}}', ',' ORDER BY hour) || ']' AS trend_hourly FROM th GROUP BY node_id)"""
ORACLES["hourly_trend_nested"] = f"{BASE},{TREND} SELECT * FROM trend"
ORACLES["detection_quality"] = f"{with_(READINGS, CLEAN, QUALITY_CTE)} SELECT * FROM quality"

ORACLES["baseline_report_flat"] = f"""{with_(READINGS, CLEAN, QUALITY_CTE, _corr_wide_cte())},
base AS (SELECT node_id, {_summary_cols()}, {_pct_cols()} FROM readings GROUP BY node_id),
pairs AS (SELECT scope AS node_id, {_pairs_select()} FROM corr_wide WHERE scope <> 'global')
SELECT base.*, q.tp AS val_tp, q.fp AS val_fp, q.tn AS val_tn, q.fn AS val_fn,
  q.precision AS val_precision, q.recall AS val_recall, q.f1 AS val_f1, q.accuracy AS val_accuracy,
  {", ".join(f"pairs.{label}" for label, _, _ in CORR_PAIRS)}
FROM base LEFT JOIN quality q USING (node_id) LEFT JOIN pairs USING (node_id)"""

_flat = ORACLES["baseline_report_flat"]
_at = _flat.rindex("\nSELECT base.*")
ORACLES["baseline_report"] = (
    f"{_flat[:_at]},{TREND},\nflat_report AS ({_flat[_at:]})\n"
    "SELECT f.*, coalesce(t.trend_hourly, '[]') AS trend_hourly FROM flat_report f LEFT JOIN trend t USING (node_id)")
ORACLES["sensor_correlation"] = f"{with_(READINGS, _corr_wide_cte())} SELECT * FROM corr_wide"
ORACLES["correlation_pairs"] = f"{with_(READINGS, _corr_wide_cte())} SELECT scope, {_pairs_select()} FROM corr_wide"
ORACLES["correlation_long"] = f"{with_(READINGS, _corr_wide_cte())} {_long_select()}"

ORACLES["enriched_readings"] = f"{BASE_ENRICHED} SELECT * FROM enriched"
FLAT = """
flat AS (SELECT * REPLACE (
    CASE WHEN node_id = 'nodo_1' THEN 0.1e0 ELSE "Smoke (ppm)" END AS "Smoke (ppm)",
    CASE WHEN node_id = 'nodo_2' THEN 25.3e0 ELSE "Temperature (C)" END AS "Temperature (C)",
    CASE WHEN node_id = 'nodo_3' THEN 0.07e0 ELSE "CO" END AS "CO") FROM readings)"""
NANS = """
nans AS (SELECT * REPLACE (
    CASE WHEN reading_index % 7 = 0 THEN NULL ELSE "Temperature (C)" END AS "Temperature (C)",
    CASE WHEN reading_index % 5 = 0 THEN NULL ELSE "Smoke (ppm)" END AS "Smoke (ppm)",
    CASE WHEN reading_index % 11 = 0 THEN NULL ELSE "CO" END AS "CO") FROM readings)"""
BASE_FLAT = with_(READINGS, FLAT, CLEAN.replace("FROM readings", "FROM flat"), _enriched_cte())
ORACLES["enriched_multichunk"] = f"{BASE_FLAT} SELECT * FROM enriched"
ORACLES["fire_transitions_multichunk"] = (f"{BASE_FLAT} SELECT node_id, reading_index, \"Fire\", is_fire, "
                                          "is_fire_transition, fire_value_prev, fire_state_label FROM enriched")
HOT_INDEX = READINGS.replace("CAST(event_id AS BIGINT) AS reading_index",
                             "CAST(CASE WHEN event_id % 8 < 4 THEN 5 ELSE event_id END AS BIGINT) AS reading_index")
ORACLES["enriched_hot_index"] = f"{with_(HOT_INDEX, CLEAN, _enriched_cte())} SELECT * FROM enriched"
ORACLES["nan_enriched"] = (f"{with_(READINGS, NANS, CLEAN.replace('FROM readings', 'FROM nans'), _enriched_cte())} "
                           "SELECT * FROM enriched")
ORACLES["running_zscore"] = (f"{BASE_ENRICHED} SELECT node_id, reading_index, zscore_Temperature, zscore_CO, "
                             "zscore_Smoke, zscore_Gas FROM enriched")
ORACLES["anomaly_flags"] = f"{BASE_ENRICHED} SELECT node_id, reading_index, is_anomaly, anomaly_sensors FROM enriched"
ORACLES["fire_transitions"] = (f"{BASE_ENRICHED} SELECT node_id, reading_index, \"Fire\", is_fire, "
                               "is_fire_transition, fire_value_prev, fire_state_label FROM enriched")
ORACLES["fire_events"] = (f"{BASE_ENRICHED} SELECT node_id, reading_index, \"Fire\" AS fire_value, fire_value_prev, "
                          "ingest_ts, \"Temperature (C)\" AS temperature_c, \"CO\" AS co, \"Smoke (ppm)\" AS smoke_ppm "
                          "FROM enriched WHERE is_fire_transition")
ORACLES["latest_reading"] = (f"{BASE} SELECT * FROM readings QUALIFY row_number() OVER (PARTITION BY node_id "
                             "ORDER BY coalesce(reading_index, 0) DESC, ingest_ts DESC) = 1")
ORACLES["node_state"] = f"""{BASE_CLEAN} SELECT node_id, {", ".join(
    f"count({Q(c)}) AS {n}_count, {R(f'avg({Q(c)})', 6)} AS {n}_mean, "
    f"{RS(f'var_pop({Q(c)}) * count({Q(c)})', 10)} AS {n}_m2" for c, n in SCORED)},
  arg_max("Fire", (coalesce(reading_index, 0), ingest_ts)) FILTER (WHERE "Fire" IS NOT NULL) AS last_fire_value
FROM clean GROUP BY node_id"""
ORACLES["node_status"] = f"{BASE_STATUS} SELECT * FROM status"

ORACLES["node_batch_stats"] = (f"{BASE_CLEAN}, b AS (SELECT *, {BATCHED} FROM clean) "
                               f"SELECT node_id, batch_id, {_batch_stats_cols()} FROM b GROUP BY node_id, batch_id")
ORACLES["cumulative_stats"] = f"""{BASE_CLEAN}, b AS (SELECT *, {BATCHED} FROM clean),
tot AS (SELECT node_id, count(*) AS total_processed, {", ".join(
    f"{R(f'sum({Q(c)})', ds)} AS running_sum_{s}, {R(f'min({Q(c)})', d)} AS running_min_{s}, "
    f"{R(f'max({Q(c)})', d)} AS running_max_{s}" for c, s, d, ds in ROLL)},
  max(batch_id) AS last_batch, max(ingest_ts) AS last_update FROM b GROUP BY node_id),
lb AS (SELECT node_id, batch_id, {", ".join(f"{RA(Q(c), d)} AS last_batch_avg_{s}" for c, s, d, _ in ROLL)}
  FROM b GROUP BY node_id, batch_id)
SELECT tot.* EXCLUDE (last_batch), {", ".join(f"lb.last_batch_avg_{s}" for _, s, _, _ in ROLL)}
FROM tot LEFT JOIN lb ON tot.node_id = lb.node_id AND tot.last_batch = lb.batch_id"""
ORACLES["cumulative_by_batch"] = f"""{BASE_CLEAN}, b AS (SELECT *, {BATCHED} FROM clean),
s AS (SELECT node_id, batch_id, {_batch_stats_cols()} FROM b GROUP BY node_id, batch_id)
SELECT node_id, batch_id, CAST(sum(batch_count) OVER w AS BIGINT) AS total_processed, {", ".join(
    f"{R(f'sum(batch_sum_{s}) OVER w', ds)} AS running_sum_{s}, min(batch_min_{s}) OVER w AS running_min_{s}, "
    f"max(batch_max_{s}) OVER w AS running_max_{s}" for _, s, _, ds in ROLL)},
  {", ".join(f"batch_avg_{s} AS last_batch_avg_{s}" for _, s, _, _ in ROLL)}
FROM s WINDOW w AS (PARTITION BY node_id ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
ORACLES["enrichment_counts"] = f"""{BASE_ENRICHED}, b AS (SELECT *, {BATCHED} FROM enriched),
per AS (SELECT node_id, batch_id, count(*) AS rows, CAST(count_if(is_fire) AS BIGINT) AS fire_rows,
  CAST(count_if(is_anomaly) AS BIGINT) AS anomaly_rows FROM b GROUP BY node_id, batch_id)
SELECT *, CAST(sum(rows) OVER (PARTITION BY batch_id) AS BIGINT) AS batch_rows FROM per"""
ORACLES["fire_distribution"] = f'{BASE} SELECT node_id, "Fire", count(*) AS n FROM readings GROUP BY 1, 2'
ORACLES["snapshot_rollup"] = f"""{BASE}, base AS (SELECT node_id, {_summary_cols()}, {_pct_cols()}
  FROM readings GROUP BY node_id)
SELECT node_id, CAST(sum(total_readings) AS BIGINT) AS sum_total_readings, max(p99_temp) AS max_p99_temp
FROM base GROUP BY node_id ORDER BY node_id"""

ORACLES["window_stats"] = f"{BASE} {_window_sql('1 minute')}"
ORACLES["window_stats_hourly"] = f"{BASE} {_window_sql('1 hour')}"
ORACLES["window_reagg"] = f"""{BASE}, win AS ({_window_sql('1 minute')})
SELECT node_id, time_bucket(INTERVAL '1 hour', window_start) AS bucket_start,
  {RA('avg_temp', 4)} AS avg_avg_temp FROM win GROUP BY 1, 2"""
HIST = ("SELECT node_id, time_bucket(INTERVAL '10 seconds', ingest_ts) AS bucket_start, "
        f"{RA(Q('Temperature (C)'), 9)} AS avg_temp, {RA(Q('CO'), 9)} AS avg_co, "
        f"{RA(Q('Smoke (ppm)'), 9)} AS avg_smoke, {RA(Q('Gas (Ohm)'), 9)} AS avg_gas FROM enriched GROUP BY 1, 2")
ORACLES["sensor_histogram"] = f"{BASE_ENRICHED} {HIST}"
ORACLES["topk_nodes"] = (f"{BASE_ENRICHED}, h AS ({HIST}), top AS (SELECT DISTINCT node_id FROM h "
                         "ORDER BY node_id DESC LIMIT 2) SELECT * FROM h WHERE node_id IN (SELECT node_id FROM top)")
ORACLES["anomaly_count"] = f"""{BASE_ENRICHED}, m AS (SELECT max(ingest_ts) AS t FROM enriched)
SELECT CAST(count(*) AS BIGINT) AS anomaly_count FROM enriched, m
WHERE is_anomaly AND ingest_ts > m.t - INTERVAL '15 minutes' AND ingest_ts <= m.t"""
ORACLES["fire_activity"] = f"""{BASE_ENRICHED},
r AS (SELECT min(time_bucket(INTERVAL '1 hour', ingest_ts)) AS a, max(time_bucket(INTERVAL '1 hour', ingest_ts)) AS b
  FROM enriched),
spine AS (SELECT n.node_id, unnest(generate_series(r.a, r.b, INTERVAL '1 hour')) AS bucket_start
  FROM (SELECT DISTINCT node_id FROM enriched) n, r),
c AS (SELECT node_id, time_bucket(INTERVAL '1 hour', ingest_ts) AS bucket_start, count(*) AS fire_count
  FROM enriched WHERE is_fire GROUP BY 1, 2)
SELECT s.node_id, s.bucket_start, coalesce(c.fire_count, 0) AS fire_count
FROM spine s LEFT JOIN c USING (node_id, bucket_start)"""
ORACLES["latest_anomalies"] = (f"{BASE_ENRICHED} SELECT node_id, reading_index, ingest_ts, anomaly_sensors, "
                               "zscore_Temperature, \"CO\" FROM enriched WHERE is_anomaly "
                               "ORDER BY ingest_ts DESC, node_id, reading_index DESC LIMIT 50")
ORACLES["node_card"] = (f"{BASE_STATUS} SELECT node_id, is_fire, CASE WHEN coalesce(is_fire, false) THEN 'FIRE' "
                        "ELSE 'NO FIRE' END AS card, last_update_ts FROM status WHERE node_id = 'nodo_1' LIMIT 1")
ORACLES["baseline_panel"] = f"""{BASE}, base AS (SELECT node_id, {_summary_cols()}, {_pct_cols()}
  FROM readings GROUP BY node_id)
SELECT node_id, p50_temp, p95_temp, p99_temp, avg_temp, p50_co, p95_co, p99_co, avg_co,
  p50_smoke, p95_smoke, p99_smoke, avg_smoke, p50_gas, p95_gas, p99_gas, avg_gas FROM base ORDER BY node_id"""
ORACLES["fire_cards"] = (f"{BASE_STATUS} SELECT node_id, is_fire, CASE WHEN coalesce(is_fire, false) THEN 'FIRE' "
                         "ELSE 'NO FIRE' END AS card FROM status")
ORACLES["panel_projection"] = (f"{BASE_STATUS} SELECT node_id, fire_state_label, map_status, temperature_c, "
                               "humidity_pct, co, smoke_ppm, gas_ohm, lat, lon FROM status")
ORACLES["severity_bands"] = (f"{BASE_ENRICHED} SELECT node_id, reading_index, "
                             f"{_band(Q('Temperature (C)'), (35.0, 45.0))} AS temp_band, "
                             f"{_band(Q('CO'), (50.0, 150.0))} AS co_band, "
                             f"{_band(Q('Smoke (ppm)'), (0.05, 0.1, 0.15))} AS smoke_band, "
                             f"{_band(Q('Gas (Ohm)'), (5000.0, 10000.0))} AS gas_band FROM enriched")
_TITLES = {"temp": "Temp", "co": "CO", "smoke": "Smoke", "gas": "Gas"}
ORACLES["baseline_panel_titled"] = (f"WITH p AS ({ORACLES['baseline_panel']}) SELECT node_id AS \"Nodo\", " + ", ".join(
    f'{st}_{s} AS "{t} {n}"' for s, t in _TITLES.items()
    for st, n in (("p50", "p50"), ("p95", "p95"), ("p99", "p99"), ("avg", "media"))) + " FROM p")
ORACLES["coverage_panel"] = (f"WITH s AS ({ORACLES['baseline_summary']}) SELECT node_id AS \"Nodo\", total_readings AS "
                             "\"Letture totali\", distinct_reading_index AS \"reading_index distinti\", "
                             "first_ingest_ts AS \"Primo ingest\", last_ingest_ts AS \"Ultimo ingest\" FROM s")
ORACLES["quality_panel"] = (f"WITH r AS ({ORACLES['baseline_report_flat']}) SELECT node_id AS \"Nodo\", val_tp AS \"TP\", "
                            "val_fp AS \"FP\", val_tn AS \"TN\", val_fn AS \"FN\", val_precision AS \"Precision\", "
                            "val_recall AS \"Recall\", val_f1 AS \"F1\", val_accuracy AS \"Accuracy\" FROM r")
ORACLES["report_bands"] = (f"WITH r AS ({ORACLES['baseline_report_flat']}) SELECT node_id, "
                           f"{_band('p99_temp', (30.0, 40.0))} AS p99_temp_band, "
                           + ", ".join(f"{_band(c, (0.5, 0.8))} AS {c}_band" for c in
                                       ("val_precision", "val_recall", "val_f1", "val_accuracy")) + ", "
                           + ", ".join(f"{_band(c, (-0.3, 0.3))} AS {c}_band" for c, _, _ in CORR_PAIRS) + " FROM r")
ORACLES["status_bands"] = (f"WITH s AS ({ORACLES['node_status']}), n AS ({ORACLES['anomaly_count']}) SELECT node_id, "
                           f"{_band('map_status', (1.0, 2.0))} AS map_band, "
                           f"{_band('anomaly_count', (1.0, 10.0))} AS anomaly_count_band FROM s, n")
ORACLES["node_fire_rows"] = (f"{BASE_ENRICHED} SELECT node_id, reading_index, ingest_ts, \"Fire\" FROM enriched "
                             "WHERE node_id = 'nodo_1' AND is_fire")

ORACLES["outlier_filter"] = f"{BASE_CLEAN} SELECT * FROM clean"
ORACLES["fire_state_label"] = f"{BASE} SELECT node_id, reading_index, \"Fire\", {LABEL} AS fire_state_label, " \
                              f"{IS_FIRE} AS is_fire FROM readings"
ORACLES["threshold_flags"] = (f"{BASE} SELECT node_id, reading_index, concat_ws(', ', " + ", ".join(
    f"CASE WHEN {Q(col)} {op} {thr} THEN '{name}' END" for name, col, op, thr in THRESH)
    + ") AS threshold_sensors FROM readings")
ORACLES["fire_rule"] = f"{BASE} SELECT node_id, reading_index, ({_fire_rule()}) AS fire_rule FROM readings"
ORACLES["map_status"] = (f"{BASE_ENRICHED} SELECT node_id, reading_index, CASE WHEN {IS_FIRE} THEN 2 "
                         "WHEN coalesce(is_anomaly, false) THEN 1 ELSE 0 END AS map_status FROM enriched")
ISO = "strftime(ingest_ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"
ORACLES["ts_parse_format"] = (f"{BASE} SELECT node_id, reading_index, {ISO} AS iso_text, "
                              "date_trunc('millisecond', ingest_ts) AS parsed_ts, "
                              "CAST(hour(ingest_ts) AS INTEGER) AS hour FROM readings")
ORACLES["nan_to_null"] = (f"{BASE} SELECT event_id, CASE WHEN k % 7 = 0 THEN NULL ELSE 20.0e0 + value / 10 END "
                          "AS temperature_c FROM ev")
ORACLES["labelled_only"] = f'{BASE} SELECT node_id, reading_index, "Fire" FROM readings WHERE "Fire" IS NOT NULL'

ISO_COLS = RAW_COLS.replace("ingest_ts", f"{ISO} AS ingest_ts")
ORACLES["decode_envelope"] = f"{BASE} SELECT {ISO_COLS} FROM readings WHERE reading_index % 100 <> 13"
ORACLES["decode_rejects"] = (f"{BASE} SELECT node_id AS key, '{{\"Temperature (C)\":' AS head, 40 AS n_chars FROM readings "
                             "WHERE reading_index % 100 = 13")
ORACLES["encode_decode_roundtrip"] = f"{BASE} SELECT node_id AS key, {ISO_COLS} FROM readings"
VT = ("CASE WHEN k % 5 = 0 THEN ' ' || CAST(value AS VARCHAR) || ' ' WHEN k % 5 = 1 THEN 'abc' "
      "WHEN k % 5 = 2 THEN '' WHEN k % 5 = 3 THEN ['nan', '1.0d', '1f', '0x10', '1_000', '-2.5e1'][k % 6 + 1] "
      "ELSE CAST(value AS VARCHAR) END")
FT = "CASE WHEN k % 8 = 0 THEN ' 2 ' WHEN k % 4 = 0 THEN chr(9) || '2' || chr(9) WHEN k % 4 = 1 THEN '1.0' WHEN k % 4 = 2 THEN '' ELSE CAST(k AS VARCHAR) END"
ORACLES["tolerant_cast"] = f"""{BASE}, t AS (SELECT event_id, {VT} AS value_text, {FT} AS fire_text FROM ev)
SELECT event_id, value_text,
  CASE WHEN regexp_full_match(trim(value_text), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
    THEN TRY_CAST(trim(value_text) AS DOUBLE) END AS value_parsed,
  fire_text,
  CASE WHEN regexp_full_match(trim(fire_text, ' ' || chr(9)), '[+-]?[0-9]+')
    THEN TRY_CAST(trim(fire_text, ' ' || chr(9)) AS INTEGER) END
    AS fire_parsed
FROM t"""
ORACLES["sequence_readings"] = """WITH s AS (
  SELECT 'nodo_' || CAST(user_id % 4 + 1 AS VARCHAR) AS node_id, event_id, ts FROM events),
r AS (SELECT node_id, event_id,
  CAST(row_number() OVER (PARTITION BY node_id ORDER BY ts, event_id) - 1 AS BIGINT) AS reading_index FROM s)
SELECT node_id, event_id, reading_index,
  TIMESTAMP '2024-01-01 00:00:00' + to_milliseconds(reading_index * 500) AS stamped_ts FROM r"""
ORACLES["sequence_hot_hour"] = ORACLES["sequence_readings"].replace(
    "event_id, ts FROM events", "event_id, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' "
    "+ to_seconds(event_id % 1800) ELSE ts END AS ts FROM events")
# the batch after a reading's own changed it, unless its own was the last
ORACLES["upsert_many_batches"] = (f"{BASE}, b AS (SELECT event_id, coalesce(k, 0) % 24 AS b FROM ev) SELECT " + RAW_COLS.replace(
    '"Temperature (C)"', 'CASE WHEN b < 23 THEN "Temperature (C)" + (b + 1) * 1.0e0 ELSE "Temperature (C)" END AS "Temperature (C)"', 1)
    + " FROM readings r JOIN b ON r.reading_index = b.event_id")
UPSERT_COLS = RAW_COLS.replace('"Temperature (C)"', 'CASE WHEN k >= 50 THEN "Temperature (C)" + 1.0e0 '
                               'ELSE "Temperature (C)" END AS "Temperature (C)"', 1)
ORACLES["upsert_latest"] = (f"{BASE} SELECT {UPSERT_COLS} FROM readings r JOIN (SELECT event_id, k FROM ev) e "
                            "ON r.reading_index = e.event_id")
SERVING = {"Temperature (C)": "temperature_c", "Humidity (%)": "humidity_pct", "Pressure (hPA)": "pressure_hpa",
           "Gas (Ohm)": "gas_ohm", "Visible Light": "visible_light", "IR": "ir", "UV index": "uv_index",
           "CO": "co", "NO2": "no2", "Smoke (ppm)": "smoke_ppm", "Fire": "fire"}
ORACLES["serving_projection"] = (f"{BASE_ENRICHED} SELECT "
                                 + ", ".join(f"{Q(k)} AS {v}" for k, v in SERVING.items())
                                 + ", node_id, reading_index, ingest_ts, zscore_Temperature, zscore_CO, "
                                 "zscore_Smoke, zscore_Gas, coalesce(is_anomaly, false) AS is_anomaly, "
                                 "anomaly_sensors, coalesce(is_fire, false) AS is_fire, is_fire_transition, "
                                 "fire_value_prev, fire_state_label FROM enriched")
ORACLES["retention_filter"] = (f"{BASE} SELECT * FROM readings WHERE ingest_ts >= "
                               "(SELECT max(ingest_ts) FROM readings) - INTERVAL '7 days'")
ORACLES["dedup_readings"] = f"{BASE} SELECT * FROM readings"
ORACLES["alert_feed"] = (f"{BASE_ENRICHED} SELECT node_id, reading_index, \"Fire\" AS fire_value, fire_value_prev, "
                         "strftime(ingest_ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingest_ts, \"Temperature (C)\" AS temperature_c, "
                         "\"CO\" AS co, \"Smoke (ppm)\" AS smoke_ppm, "
                         + " || ".join(["'{\"node_id\":\"' || node_id || '\"'"] + [
                             f"',\"{n}\":' || coalesce(CAST({v} AS VARCHAR), 'null')" for n, v in (
                                 ("fire_value", '"Fire"'), ("fire_value_prev", "fire_value_prev"),
                                 ("ingest_ts", "'\"' || strftime(ingest_ts, '%Y-%m-%dT%H:%M:%S.%f') || '\"'"),
                                 ("temperature_c", '"Temperature (C)"'), ("co", '"CO"'), ("smoke_ppm", '"Smoke (ppm)"'))])
                         + " || '}' AS payload FROM enriched WHERE is_fire_transition")
ORACLES["audit_counts"] = f"""{BASE_STATUS}
SELECT 'raw_readings' AS table_name, count(*) AS row_count FROM readings
UNION ALL SELECT 'processed_readings', count(*) FROM enriched
UNION ALL SELECT 'fire_events', count(*) FROM enriched WHERE is_fire_transition
UNION ALL SELECT 'window_stats', count(*) FROM (SELECT DISTINCT node_id, time_bucket(INTERVAL '1 minute', ingest_ts)
  FROM readings WHERE ingest_ts IS NOT NULL)
UNION ALL SELECT 'node_status', count(*) FROM status"""


# The streams' stored tables equal their batch twins; times travel as ISO text in milliseconds.
MILLIS = READINGS.replace("ts AS ingest_ts", "date_trunc('millisecond', ts) AS ingest_ts")
ORACLES["stream_raw"] = f"{BASE} SELECT {ISO_COLS} FROM readings"
ORACLES["stream_enriched"] = f"{with_(MILLIS, CLEAN, _enriched_cte())} SELECT * REPLACE ({ISO} AS ingest_ts) FROM enriched"
ORACLES["stream_node_status"] = (f"{with_(MILLIS, CLEAN, _enriched_cte(), STATUS_CTE)} SELECT * REPLACE ("
                                 f"{ISO.replace('ingest_ts', 'last_ingest_ts')} AS last_ingest_ts, "
                                 f"{ISO.replace('ingest_ts', 'last_update_ts')} AS last_update_ts) FROM status")
ORACLES["stream_window_stats"] = f"{with_(MILLIS)} {_window_sql('1 minute')}"


ORACLES["stream_dedup"] = ORACLES["stream_enriched"]
# part p admits a row unless its window ends by the newest time of the parts before it, less two minutes
ADMITTED = """
sent AS (SELECT *, CAST(floor((reading_index + CASE WHEN reading_index % 20 = 7 THEN n // 2 WHEN reading_index % 20 = 9 THEN 5 ELSE 0 END)
  * 8 / (3 * n)) AS INTEGER) AS part FROM (SELECT *, count(*) OVER () AS n FROM readings_sent)),
marks AS (SELECT part, max(max(ingest_ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - INTERVAL '2 minutes' AS mark FROM sent GROUP BY part),
readings AS (SELECT s.* EXCLUDE (n, part) FROM sent s JOIN marks m ON s.part = m.part
  WHERE m.mark IS NULL OR time_bucket(INTERVAL '1 minute', s.ingest_ts) + INTERVAL '1 minute' > m.mark)"""
ORACLES["stream_late_rows"] = (f"{with_(MILLIS.replace('readings AS (', 'readings_sent AS (', 1), ADMITTED)} {_window_sql('1 minute')}")
ORACLES["stream_concurrent"] = f"""{with_(MILLIS, CLEAN)}
SELECT 'raw_readings' AS table_name, count(*) AS row_count FROM readings
UNION ALL SELECT 'rejects', 0
UNION ALL SELECT 'processed_readings', count(*) FROM clean
UNION ALL SELECT 'window_stats', count(*) FROM (SELECT DISTINCT node_id, time_bucket(INTERVAL '1 minute', ingest_ts)
  FROM readings WHERE ingest_ts IS NOT NULL)
UNION ALL SELECT 'node_status', count(DISTINCT node_id) FROM clean
UNION ALL SELECT 'cumulative', count(DISTINCT node_id) FROM clean"""
ORACLES["csv_readings"] = (f"{BASE} SELECT " + RAW_COLS.replace('"Fire"', "CASE WHEN node_id <> 'nodo_3' THEN \"Fire\" END AS \"Fire\"")
                           .replace(", reading_index, ingest_ts", "") + " FROM readings")
ORACLES["sql_functions"] = (f"{BASE} SELECT node_id, reading_index, {LABEL} AS fire_state_label, {IS_FIRE} AS is_fire, "
                            f"CASE WHEN {IS_FIRE} THEN 2 WHEN coalesce(\"CO\" > 50, false) THEN 1 ELSE 0 END AS map_status, "
                            f"{_band(Q('Temperature (C)'), (35.0, 45.0))} AS temp_band, "
                            f"{_band(Q('CO'), (50.0, 150.0))} AS co_band, "
                            f"{_band(Q('Smoke (ppm)'), (0.05, 0.1, 0.15))} AS smoke_band, "
                            f"{_band(Q('Gas (Ohm)'), (5000.0, 10000.0))} AS gas_band FROM readings")
ORACLES["stored_counts"] = f"""{BASE}
SELECT 'raw_readings' AS table_name, count(*) AS row_count FROM readings
UNION ALL SELECT 'window_stats', count(*) FROM (SELECT DISTINCT node_id, time_bucket(INTERVAL '1 minute', ingest_ts)
  FROM readings WHERE ingest_ts IS NOT NULL)
UNION ALL SELECT 'baseline', count(DISTINCT node_id) FROM readings"""
ORACLES["snapshot_report"] = ORACLES["mirror_report"] = ORACLES["baseline_percentiles"]
ORACLES["retention_purged"] = ORACLES["retention_filter"]


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
