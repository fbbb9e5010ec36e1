"""Hand-made reading rows and a plain-Python row loop written from the
definitions (second oracle for the ordered operators)."""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import types as T

from firesight.spec import SENSOR_COLUMNS, reading_schema

TS_SCHEMA = T.StructType([f if f.name != "ingest_ts" else T.StructField("ingest_ts", T.TimestampNTZType(), True)
                          for f in reading_schema().fields])


def reading(node, idx, temp=25.0, co=1.0, smoke=0.01, gas=100000.0, fire=0, ts=None, **extra):
    import datetime as dt
    row = {c: None for c in SENSOR_COLUMNS}
    row.update({"Temperature (C)": temp, "CO": co, "Smoke (ppm)": smoke, "Gas (Ohm)": gas,
                "Humidity (%)": 50.0, "Pressure (hPA)": 1010.0})
    row.update(extra)
    row["Fire"] = fire
    row["node_id"] = node
    row["reading_index"] = idx
    row["ingest_ts"] = ts or (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=idx if idx is not None else 0))
    return tuple(row[f.name] for f in TS_SCHEMA.fields)


def frame(spark, rows):
    return spark.createDataFrame(rows, TS_SCHEMA)


def half_up(v, n):
    return float(Decimal(repr(v)).quantize(Decimal(1).scaleb(-n), ROUND_HALF_UP)) + 0.0


SCORED = (("Temperature (C)", "Temperature"), ("CO", "CO"), ("Smoke (ppm)", "Smoke"), ("Gas (Ohm)", "Gas"))
THRESH = (("CO", "CO", ">", 50.0), ("Smoke", "Smoke (ppm)", ">", 0.08),
          ("Temperature", "Temperature (C)", ">", 35.0), ("Gas", "Gas (Ohm)", "<", 5000.0))


def loop_enrich(rows: list[dict]) -> dict:
    """Sequential Welford per node, in index order (null as 0)."""
    out = {}
    by_node = {}
    for r in rows:
        if r["CO"] is None or r["Gas (Ohm)"] is None or not (r["CO"] < 1000 and r["Gas (Ohm)"] < 1_000_000):
            continue
        by_node.setdefault(r["node_id"], []).append(r)
    for node, rs in by_node.items():
        rs.sort(key=lambda r: (r["reading_index"] if r["reading_index"] is not None else 0, r["ingest_ts"]))
        st = {}
        last = None
        for r in rs:
            res = {}
            for col, name in SCORED:
                x = r[col]
                if x is None:
                    res[f"zscore_{name}"] = None
                    continue
                n, mean, m2 = st.get(name, (0, 0.0, 0.0))
                n += 1
                d = x - mean
                mean += d / n
                m2 += d * (x - mean)
                st[name] = (n, mean, m2)
                std = math.sqrt(m2 / (n - 1)) if n > 1 else 0.0
                res[f"zscore_{name}"] = half_up((x - mean) / std, 3) if std > 0 else 0.0
            flags = [name for _, name in SCORED if abs(res[f"zscore_{name}"] or 0.0) > 2.0]
            for name, col, op, thr in THRESH:
                v = r[col]
                if v is not None and name not in flags and ((op == ">" and v > thr) or (op == "<" and v < thr)):
                    flags.append(name)
            res["is_anomaly"] = bool(flags)
            res["anomaly_sensors"] = ", ".join(flags)
            f = r["Fire"]
            res["is_fire"] = f is not None and f >= 1
            res["is_fire_transition"] = bool(f is not None and f >= 1 and (last is None or last == 0))
            res["fire_value_prev"] = int(last) if last is not None else 0
            res["fire_state_label"] = ("N/A" if f is None else "NORMAL" if f == 0 else "FIRE" if f == 1
                                       else "SPECIAL")
            if f is not None:
                last = f
            out[(node, r["reading_index"])] = res
    return out
