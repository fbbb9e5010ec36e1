"""Sensor specification: names, thresholds and fixed parameters.

One frozen object shared by the batch and the streaming forms of every
operator, so the thresholds cannot drift between the two paths.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference application's values for the
# results to agree; they are stated here once, in their natural order.
# ---------------------------------------------------------------------------

# Raw reading columns, in message order.
SENSOR_COLUMNS = (
    "Temperature (C)",
    "Humidity (%)",
    "Pressure (hPA)",
    "Gas (Ohm)",
    "Visible Light",
    "IR",
    "UV index",
    "CO",
    "NO2",
    "Smoke (ppm)",
)

# Serving (snake_case) names for the raw columns.
SERVING_NAMES = {
    "Temperature (C)": "temperature_c",
    "Humidity (%)": "humidity_pct",
    "Pressure (hPA)": "pressure_hpa",
    "Gas (Ohm)": "gas_ohm",
    "Visible Light": "visible_light",
    "IR": "ir",
    "UV index": "uv_index",
    "CO": "co",
    "NO2": "no2",
    "Smoke (ppm)": "smoke_ppm",
    "Fire": "fire",
    "node_id": "node_id",
    "reading_index": "reading_index",
    "ingest_ts": "ingest_ts",
}

# Outlier bounds (strict "<"; nulls fail the test and are dropped).
CO_MAX = 1000.0
GAS_MAX = 1_000_000.0

# Scored sensors in flag order: (raw column, z-score/flag name, stats suffix).
SCORED_SENSORS = (
    ("Temperature (C)", "Temperature", "temp"),
    ("CO", "CO", "co"),
    ("Smoke (ppm)", "Smoke", "smoke"),
    ("Gas (Ohm)", "Gas", "gas"),
)

# Sensors of roll-ups and windows: (raw column, suffix, decimals of avg/min/max,
# decimals of sum, the extreme that the window table keeps).
ROLLUP_SENSORS = (
    ("Temperature (C)", "temp", 2, 4, "max"),
    ("CO", "co", 2, 4, "max"),
    ("Smoke (ppm)", "smoke", 4, 4, "max"),
    ("Gas (Ohm)", "gas", 2, 2, "min"),
)

# Short names of the correlation sensors, used in wide column names.
SHORT_NAMES = {
    "Temperature (C)": "temp",
    "Humidity (%)": "hum",
    "Pressure (hPA)": "press",
    "Gas (Ohm)": "gas",
    "CO": "co",
    "NO2": "no2",
    "Smoke (ppm)": "smoke",
}

# Absolute anomaly thresholds, in the order they are appended to the flag list:
# (flag name, raw column, comparison, threshold).
THRESHOLD_RULES = (
    ("CO", "CO", ">", 50.0),
    ("Smoke", "Smoke (ppm)", ">", 0.08),
    ("Temperature", "Temperature (C)", ">", 35.0),
    ("Gas", "Gas (Ohm)", "<", 5000.0),
)

# |z| above this (after rounding z to 3 decimals) flags the sensor.
Z_THRESHOLD = 2.0
Z_DECIMALS = 3

# Percentile points and accuracy of the batch baseline.
PERCENTILES = (0.5, 0.95, 0.99)
PERCENTILE_ACCURACY = 10000

# Correlation matrix sensors, in row/column order.
CORR_SENSORS = (
    "Temperature (C)",
    "Humidity (%)",
    "Pressure (hPA)",
    "Gas (Ohm)",
    "CO",
    "NO2",
    "Smoke (ppm)",
)

# Correlation pairs extracted as scalar columns: (label, sensor a, sensor b).
CORR_PAIRS = (
    ("corr_temp_co", "Temperature (C)", "CO"),
    ("corr_temp_gas", "Temperature (C)", "Gas (Ohm)"),
    ("corr_temp_smoke", "Temperature (C)", "Smoke (ppm)"),
    ("corr_co_smoke", "CO", "Smoke (ppm)"),
    ("corr_co_gas", "CO", "Gas (Ohm)"),
    ("corr_smoke_gas", "Smoke (ppm)", "Gas (Ohm)"),
)

# Node coordinates (lat, lon).
NODE_COORDS = {
    "nodo_1": (39.290, 9.400),
    "nodo_2": (39.275, 9.420),
    "nodo_3": (39.300, 9.435),
    "nodo_4": (39.265, 9.395),
}

# Fire label values.
FIRE_LABELS = {None: "N/A", 0: "NORMAL", 1: "FIRE"}
FIRE_LABEL_OTHER = "SPECIAL"

# Streaming window, watermark and trigger.
WINDOW_DURATION = "1 minute"
WATERMARK_DELAY = "2 minutes"
TRIGGER_INTERVAL = "5 seconds"
MAX_OFFSETS_PER_TRIGGER = 200

# Retention periods.
RETENTION = {
    "raw": "7 days",
    "enriched": "3 days",
    "fire_events": "30 days",
    "topic": "24 hours",
}

# Dashboard severity steps (ascending; a value >= step takes that band).
SEVERITY_STEPS = {
    "temperature_c": (35.0, 45.0),
    "co": (50.0, 150.0),
    "smoke_ppm": (0.05, 0.1, 0.15),
    "gas_ohm": (5000.0, 10000.0),
    "anomaly_count": (1.0, 10.0),
    "p99_temp": (30.0, 40.0),
    "metric": (0.5, 0.8),
    "correlation": (-0.3, 0.3),
    "map_status": (1.0, 2.0),
}

# Dashboard histogram bucket and list sizes.
HISTOGRAM_BUCKET = "10 seconds"
LATEST_ANOMALIES = 50
TOP_NODES = 4

# Timestamp text format (ISO-8601, milliseconds, UTC "Z").
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# ---------------------------------------------------------------------------


def reading_schema() -> T.StructType:
    """Schema of one reading message / raw reading row."""
    fields = [T.StructField(c, T.DoubleType(), True) for c in SENSOR_COLUMNS]
    fields += [
        T.StructField("Fire", T.IntegerType(), True),
        T.StructField("node_id", T.StringType(), False),
        # long, not int: an index past 2^31 must not overflow at scale
        T.StructField("reading_index", T.LongType(), True),
        T.StructField("ingest_ts", T.StringType(), True),
    ]
    return T.StructType(fields)


@dataclass(frozen=True)
class SensorSpec:
    """All semantics-bearing parameters of the engine, immutable."""

    co_max: float = CO_MAX
    gas_max: float = GAS_MAX
    scored: tuple = SCORED_SENSORS
    thresholds: tuple = THRESHOLD_RULES
    z_threshold: float = Z_THRESHOLD
    z_decimals: int = Z_DECIMALS
    percentiles: tuple = PERCENTILES
    percentile_accuracy: int = PERCENTILE_ACCURACY
    corr_sensors: tuple = CORR_SENSORS
    corr_pairs: tuple = CORR_PAIRS
    node_coords: dict = field(default_factory=lambda: dict(NODE_COORDS))
    serving_names: dict = field(default_factory=lambda: dict(SERVING_NAMES))
    window_duration: str = WINDOW_DURATION
    watermark_delay: str = WATERMARK_DELAY

    @property
    def schema(self) -> T.StructType:
        return reading_schema()

    def suffix(self, raw: str) -> str:
        for col, _, suf in self.scored:
            if col == raw:
                return suf
        raise KeyError(raw)


DEFAULT_SPEC = SensorSpec()
