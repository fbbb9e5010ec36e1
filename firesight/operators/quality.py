"""Detection quality of the physical fire rule against the Fire label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firesight.functions.columns import fire_rule
from firesight.spec import DEFAULT_SPEC, SensorSpec

METRIC_DECIMALS = 4


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0.0 when the denominator is zero."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def detection_quality(readings: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Confusion matrix and precision/recall/F1/accuracy per node.

    Positives are ``Fire >= 1``; rows without a label are excluded; a null
    sensor counts as "threshold not passed". One partial aggregate, no collect.
    """
    actual = F.col("Fire") >= 1
    pred = fire_rule(spec)
    counts = (readings.filter(F.col("Fire").isNotNull())
              .groupBy("node_id")
              .agg(F.count_if(actual & pred).alias("tp"),
                   F.count_if(~actual & pred).alias("fp"),
                   F.count_if(~actual & ~pred).alias("tn"),
                   F.count_if(actual & ~pred).alias("fn")))
    return counts.select("node_id", *[col.alias(name) for name, col in metric_columns()])


def metric_columns() -> list[tuple[str, Column]]:
    """(name, column) of the counts and the ratios, from columns tp/fp/tn/fn."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    f1 = _ratio(F.lit(2.0) * precision * recall, precision + recall)
    accuracy = _ratio(tp + tn, tp + fp + tn + fn)
    return [("tp", tp), ("fp", fp), ("tn", tn), ("fn", fn),
            ("precision", F.round(precision, METRIC_DECIMALS)),
            ("recall", F.round(recall, METRIC_DECIMALS)),
            ("f1", F.round(f1, METRIC_DECIMALS)),
            ("accuracy", F.round(accuracy, METRIC_DECIMALS))]
