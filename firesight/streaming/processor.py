"""Stateful enrichment for streams (T4): per-node running statistics kept in
Spark's checkpointed state store, so they commit together with the source
offsets (a retried micro-batch starts again from the committed state).

The stateful step returns what needs the state only: the z-scores and the
previous fire value of every row. Rows arrive as pandas frames; they are
ordered by index (null as 0) and scored with vectorised running sums merged
with the carried state - the same pairwise update as the batch prefix scan,
with the carried state as the prefix. Flags and labels are Spark expressions
after it, shared with the batch form (``enrich.finish``). Rows of a node that
arrive in a later micro-batch are scored then, after everything already seen.
One node is one task per micro-batch: its rows are bounded by the trigger's
file or offset limit. They are scored in pieces of ``PIECE`` rows against the
carried state; more rows than that are kept as sorted runs on disk and merged,
so a worker holds a piece and the order keys only.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from firesight.spec import DEFAULT_SPEC, ROLLUP_SENSORS, SensorSpec

PREV_FIRE = "_prev_fire"
#: A node's running totals after a micro-batch; they travel on its last row, the other rows hold null.
TOTALS = "_totals"
#: Rows of a node that are sorted and scored at a time.
PIECE = 1 << 16


def state_schema(spec: SensorSpec = DEFAULT_SPEC) -> T.StructType:
    """Count, mean and M2 of every scored sensor, and the last non-null fire value."""
    return T.StructType(
        [T.StructField(f"{name}_{part}", T.LongType() if part == "count" else T.DoubleType(), True)
         for _, name, _ in spec.scored for part in ("count", "mean", "m2")]
        + [T.StructField("last_fire_value", T.IntegerType(), True)])


def totals_schema() -> T.StructType:
    """Rows, and sum, min and max of every rolled-up sensor."""
    return T.StructType([T.StructField("total_processed", T.LongType(), True)]
                        + [T.StructField(f"{part}_{suf}", T.DoubleType(), True)
                           for _, suf, *_ in ROLLUP_SENSORS for part in ("sum", "min", "max")])


def scored_schema(input_schema: T.StructType, spec: SensorSpec = DEFAULT_SPEC) -> T.StructType:
    return T.StructType(list(input_schema.fields)
                        + [T.StructField(f"zscore_{name}", T.DoubleType(), True) for _, name, _ in spec.scored]
                        + [T.StructField(PREV_FIRE, T.IntegerType(), True)]
                        + [T.StructField(f"{TOTALS}_{f.name}", f.dataType, True) for f in totals_schema()])


def add_totals(pdf: pd.DataFrame, totals: dict, spec: SensorSpec = DEFAULT_SPEC) -> dict:
    """The running totals with a piece's rows added; a sensor without a value yet has null for all three."""
    new = {"total_processed": int(totals.get("total_processed") or 0) + len(pdf)}
    for col, suf, *_ in ROLLUP_SENSORS:
        x = pdf[spec.serving_names[col]].to_numpy(dtype="float64", na_value=np.nan)
        x = x[~np.isnan(x)]
        held = [totals[f"{part}_{suf}"] for part in ("sum", "min", "max")] if totals.get(f"sum_{suf}") is not None else []
        if len(x):
            parts = [math.fsum([*held[:1], *x.tolist()]), float(min([x.min(), *held[1:2]])), float(max([x.max(), *held[2:]]))]
        else:
            parts = held or [None] * 3
        new.update(zip((f"sum_{suf}", f"min_{suf}", f"max_{suf}"), parts))
    return new


def with_totals(pdf: pd.DataFrame, totals: dict | None) -> pd.DataFrame:
    """The totals' columns: null, but on the last row if ``totals`` are given."""
    for f in totals_schema():
        whole = f.dataType == T.LongType()
        values, missing = np.zeros(len(pdf), "int64" if whole else "float64"), np.ones(len(pdf), bool)
        if totals is not None and totals[f.name] is not None:
            values[-1], missing[-1] = totals[f.name], False
        pdf[f"{TOTALS}_{f.name}"] = (pd.arrays.IntegerArray if whole else pd.arrays.FloatingArray)(values, missing)
    return pdf


def _round_half_up(z: np.ndarray, decimals: int) -> np.ndarray:
    """Half-up rounding on the decimal text, like Spark's ``round``.

    Vectorised; only values within a hair of a tie (rare) go through
    ``Decimal`` on their shortest text, where binary rounding could differ.
    """
    from decimal import ROUND_HALF_UP, Decimal
    scale = 10.0 ** decimals
    with np.errstate(invalid="ignore"):
        scaled = z * scale
        frac = np.abs(scaled - np.trunc(scaled))
        out = np.sign(z) * np.floor(np.abs(scaled) + 0.5) / scale
        near_tie = np.abs(frac - 0.5) < 1e-6
    quantum = Decimal(1).scaleb(-decimals)
    for i in np.flatnonzero(near_tie & ~np.isnan(z)):
        out[i] = float(Decimal(repr(float(z[i]))).quantize(quantum, ROUND_HALF_UP))
    return out + 0.0


def score_frame(pdf: pd.DataFrame, state: dict, spec: SensorSpec = DEFAULT_SPEC) -> tuple[pd.DataFrame, dict]:
    """Z-scores and previous fire value of one node's new rows (already ordered, snake_case
    column names) against its carried state; returns the rows and the new state."""
    out, safe = pdf.copy(), spec.serving_names
    new_state = dict(state)
    for col, name, _ in spec.scored:
        x = out[safe[col]].to_numpy(dtype="float64", na_value=np.nan)
        valid = ~np.isnan(x)
        cn = float(state.get(f"{name}_count") or 0)
        cmean = float(state.get(f"{name}_mean") or 0.0)
        cm2 = float(state.get(f"{name}_m2") or 0.0)
        shift = cmean if cn > 0 else (x[valid][0] if valid.any() else 0.0)
        y = np.where(valid, x - shift, 0.0)
        ln = np.cumsum(valid).astype("float64")
        s1 = np.cumsum(y)
        s2 = np.cumsum(y * y)
        with np.errstate(invalid="ignore", divide="ignore"):
            lmean_y = np.where(ln > 0, s1 / ln, 0.0)
            lm2 = np.maximum(np.where(ln > 0, s2 - s1 * s1 / ln, 0.0), 0.0)
            cmean_y = cmean - shift
            n = cn + ln
            delta = lmean_y - cmean_y
            mean_y = np.where(n > 0, cmean_y + delta * ln / n, 0.0)
            m2 = cm2 + lm2 + np.where(n > 0, delta * delta * cn * ln / n, 0.0)
            std = np.sqrt(m2 / (n - 1))
            z = (y - mean_y) / std
        z = np.where((n > 1) & (m2 > 0), z, 0.0)
        z = _round_half_up(np.where(valid, z, np.nan), spec.z_decimals)
        out[f"zscore_{name}"] = pd.Series(z, index=out.index).where(valid, None)
        if len(x):
            new_state[f"{name}_count"] = int(n[-1])
            new_state[f"{name}_mean"] = float(mean_y[-1] + shift) if n[-1] > 0 else 0.0
            new_state[f"{name}_m2"] = float(m2[-1])

    # previous non-null fire value, carried across rows and batches
    last = state.get("last_fire_value")
    fire = pd.concat([pd.Series([last], dtype="Int32"), out[safe["Fire"]].astype("Int32")], ignore_index=True).ffill()
    out[PREV_FIRE] = fire.iloc[:-1].to_numpy(dtype=object, na_value=None)
    out[PREV_FIRE] = out[PREV_FIRE].astype("Int32")
    new_state["last_fire_value"] = None if pd.isna(fire.iloc[-1]) else int(fire.iloc[-1])
    return out, new_state


def order_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    key = pdf["reading_index"].fillna(0).astype("int64")
    if key.is_unique:  # times decide nothing
        return pdf.iloc[np.argsort(key.to_numpy())]
    return pdf.assign(_ord=key).sort_values(["_ord", "ingest_ts"], kind="stable").drop(columns="_ord")


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The frames' rows in sorted frames of PIECE rows (the last has fewer)."""
    held, n = [], 0
    for frame in frames:
        for at in range(0, len(frame), PIECE):
            part = frame.iloc[at:at + PIECE]
            while n + len(part) >= PIECE:
                cut = PIECE - n
                yield order_rows(pd.concat([*held, part.iloc[:cut]], ignore_index=True))
                held, n, part = [], 0, part.iloc[cut:]
            if len(part):
                held.append(part)
                n += len(part)
    if n:
        yield order_rows(pd.concat(held, ignore_index=True))


def in_pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All rows in order, in frames of PIECE rows: the order of ``order_rows`` over their concatenation."""
    runs = _runs(frames)
    first, second = next(runs, None), next(runs, None)
    if second is None:
        if first is not None:
            yield first
        return
    with tempfile.TemporaryDirectory() as folder:
        stored, index, stamps = [], [], []
        for i, run in enumerate(x for part in ([first, second], runs) for x in part):
            rows = pa.Table.from_pandas(run, preserve_index=False)
            with pa.OSFile(f"{folder}/{i}", "wb") as f, pa.ipc.new_file(f, rows.schema) as out:
                out.write_table(rows)
            index.append(run["reading_index"].fillna(0).astype("int64").to_numpy())
            stamps.append(run["ingest_ts"])
            stored.append(pa.ipc.open_file(pa.memory_map(f"{folder}/{i}")).read_all())
        sizes = [len(x) for x in index]
        del first, second
        keys = pd.DataFrame({"_ord": np.concatenate(index), "ingest_ts": pd.concat(stamps, ignore_index=True)})
        order = keys.sort_values(["_ord", "ingest_ts"], kind="stable").index.to_numpy()
        stops = np.cumsum(sizes)
        for at in range(0, len(order), PIECE):
            rows = np.sort(order[at:at + PIECE])  # a slice of each run, as runs are sorted
            cuts = np.searchsorted(rows, stops)
            parts, lo = [], 0
            for run, hi, stop, size in zip(stored, cuts, stops, sizes):
                if hi > lo:
                    parts.append(run.slice(int(rows[lo] - (stop - size)), int(hi - lo)).to_pandas())
                lo = hi
            yield order_rows(pd.concat(parts, ignore_index=True))


class Enricher(StatefulProcessor):
    """Per-node Welford and fire state, and the node's running totals: two ValueStates per node."""

    #: Set by ``init``; without it (a processor outside a query) totals start anew in every call.
    totals = None

    def __init__(self, spec: SensorSpec = DEFAULT_SPEC) -> None:
        self.spec = spec

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.fields = state_schema(self.spec).fieldNames()
        self.state = handle.getValueState("stats", state_schema(self.spec))
        self.totals = handle.getValueState("totals", totals_schema())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state, last = None, None
        names = totals_schema().fieldNames()
        for pdf in in_pieces(rows):
            if state is None:
                state = dict(zip(self.fields, self.state.get())) if self.state.exists() else {}
                totals = dict(zip(names, self.totals.get())) if self.totals and self.totals.exists() else {}
            for col, _, _ in self.spec.scored:
                name = self.spec.serving_names[col]
                pdf[name] = pdf[name].astype("float64")
            if last is not None:
                yield with_totals(last, None)
            totals = add_totals(pdf, totals, self.spec)
            last, state = score_frame(pdf, state, self.spec)
        if state is not None:
            yield with_totals(last, totals)
            self.state.update(tuple(state.get(f) for f in self.fields))
            if self.totals:
                self.totals.update(tuple(totals[n] for n in names))

    def close(self) -> None:
        pass
