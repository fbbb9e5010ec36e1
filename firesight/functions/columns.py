"""Scalar column helpers (P1-P15). All are built-in expressions: they stay
inside whole-stage codegen and need no Python at run time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firesight.spec import DEFAULT_SPEC, FIRE_LABEL_OTHER, FIRE_LABELS, ISO_FORMAT, SensorSpec


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def _compare(c: Column, op: str, value: float) -> Column:
    if op == ">":
        return c > F.lit(value)
    if op == "<":
        return c < F.lit(value)
    if op == ">=":
        return c >= F.lit(value)
    if op == "<=":
        return c <= F.lit(value)
    raise ValueError(op)


# P1 ---------------------------------------------------------------------------
def outlier_condition(spec: SensorSpec = DEFAULT_SPEC) -> Column:
    """True only for a reading inside both bounds; null and NaN fail."""
    return (q("CO") < F.lit(spec.co_max)) & (q("Gas (Ohm)") < F.lit(spec.gas_max))


def clean(df: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Drop outliers. A null comparison is not true, so null CO/Gas go too."""
    return df.filter(outlier_condition(spec))


# P2 / P3 ----------------------------------------------------------------------
def fire_state_label(c: Column) -> Column:
    return (F.when(c.isNull(), F.lit(FIRE_LABELS[None]))
            .when(c == 0, F.lit(FIRE_LABELS[0]))
            .when(c == 1, F.lit(FIRE_LABELS[1]))
            .otherwise(F.lit(FIRE_LABEL_OTHER)))


def is_fire(c: Column) -> Column:
    return F.coalesce(c >= 1, F.lit(False))


# P4 / P5 ----------------------------------------------------------------------
def threshold_flags(spec: SensorSpec = DEFAULT_SPEC) -> Column:
    """Array of flag names whose absolute threshold is passed, in rule order."""
    items = [F.when(_compare(q(col), op, thr), F.lit(name))
             for name, col, op, thr in spec.thresholds]
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def fire_rule(spec: SensorSpec = DEFAULT_SPEC) -> Column:
    """Physical fire predictor: OR of the four thresholds, null counts as false."""
    out = None
    for _, col, op, thr in spec.thresholds:
        term = F.coalesce(_compare(q(col), op, thr), F.lit(False))
        out = term if out is None else (out | term)
    return out


# P6 ---------------------------------------------------------------------------
def map_status(fire: Column, anomaly: Column) -> Column:
    """2 = fire, 1 = anomaly, 0 = normal."""
    return (F.when(is_fire(fire), F.lit(2))
            .when(F.coalesce(anomaly, F.lit(False)), F.lit(1))
            .otherwise(F.lit(0)))


# P7 / P8 ----------------------------------------------------------------------
def parse_ts(c: Column) -> Column:
    """ISO-8601 text to timestamp; junk gives null instead of an error."""
    return F.try_to_timestamp(c)


def iso_ts(c: Column) -> Column:
    """Timestamp to ISO text with milliseconds and a UTC 'Z'."""
    return F.date_format(c, ISO_FORMAT)


def event_time(df: DataFrame, col: str = "ingest_ts") -> Column:
    """Event time as a timestamp whatever the stored type (text or timestamp)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StringType):
        return parse_ts(F.col(col))
    return F.col(col)


def order_value(df: DataFrame, index: str = "reading_index", ts: str = "ingest_ts") -> Column:
    """A reading's place in its node's order as one number: index (null as
    0), then time (null first). A decimal, not a struct, so that ``max`` and
    ``max_by`` over it run as hash aggregates."""
    ord_ = F.coalesce(F.col(index).cast("long"), F.lit(0)).cast("decimal(19,0)")
    at = event_time(df, ts)
    micros = F.coalesce(F.unix_micros(at.cast("timestamp")) + F.lit(10 ** 17), F.lit(0)).cast("decimal(18,0)")
    return (ord_ * F.lit(10 ** 18).cast("decimal(19,0)") + micros).cast("decimal(38,0)")


def hour_of_day(c: Column) -> Column:
    return F.hour(c)


# P9 / P10 ---------------------------------------------------------------------
def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def nan_to_null_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: nan_to_null(q(c)) for c in columns})


EXACT_DECIMAL = "decimal(38,12)"


def exact_avg(c: Column, decimals: int) -> Column:
    """Average rounded half-up to ``decimals``, summed in decimal arithmetic.

    A double sum depends on the order rows are added (that is, on the
    partitioning), which can move an average that is exactly on a rounding
    tie to either side. The decimal sum is exact, so the rounded result is the
    same however the rows are split. If a value doesn't fit the decimal (1e26
    and more, infinite, NaN), the plain double average of all values is returned:
    no row is left out. (NaN readings are nulls from the source on.)
    """
    exact = c.try_cast(EXACT_DECIMAL)
    return F.when(F.count(exact) == F.count(c), F.round(F.avg(exact), decimals).cast("double")).otherwise(
        F.round(F.avg(c), decimals))


def round_significant(c: Column, digits: int) -> Column:
    """Round to ``digits`` significant digits (half-up on the decimal text).

    For large sums of squares a fixed number of decimals sits at the last
    bits of a double, which differ with summation order; a relative rounding
    does not."""
    exp = F.floor(F.log10(F.abs(c)))
    scale = F.pow(F.lit(10.0), exp)
    return F.when(c == 0, F.lit(0.0)).otherwise(F.round(c / scale, digits - 1) * scale)


# P13 / P14 --------------------------------------------------------------------
def band(c: Column, steps: Sequence[float]) -> Column:
    """Index of the highest step the value reaches (0 = below the first)."""
    out = F.lit(0)
    for i, s in enumerate(steps, start=1):
        out = F.when(c >= F.lit(float(s)), F.lit(i)).otherwise(out)
    return F.when(c.isNotNull(), out)


def fire_card(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), F.lit("FIRE")).otherwise(F.lit("NO FIRE"))
