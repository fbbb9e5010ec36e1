"""The row-local helpers as SQL functions of the session.

They are SQL-language functions: Catalyst inlines their bodies like a view's, so a query in SQL text gets the same
expressions as the DataFrame helpers, inside generated code.
Their bodies are written from the same fixed values (``spec.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from firesight.spec import FIRE_LABEL_OTHER, FIRE_LABELS, SEVERITY_STEPS


def _band(steps: Sequence[float]) -> str:
    cases = " ".join(f"WHEN x >= {float(s)!r}D THEN {i}" for i, s in reversed(list(enumerate(steps, start=1))))
    return f"CASE WHEN x IS NULL THEN NULL {cases} ELSE 0 END"


def definitions() -> dict[str, str]:
    """Signature and body of every function, by name."""
    labels = " ".join(f"WHEN fire = {v} THEN '{t}'" for v, t in FIRE_LABELS.items() if v is not None)
    out = {
        "fire_state_label": "(fire INT) RETURNS STRING RETURN "
                            f"CASE WHEN fire IS NULL THEN '{FIRE_LABELS[None]}' {labels} ELSE '{FIRE_LABEL_OTHER}' END",
        "is_fire": "(fire INT) RETURNS BOOLEAN RETURN coalesce(fire >= 1, false)",
        "map_status": "(fire INT, anomaly BOOLEAN) RETURNS INT RETURN "
                      "CASE WHEN coalesce(fire >= 1, false) THEN 2 WHEN coalesce(anomaly, false) THEN 1 ELSE 0 END",
    }
    for name, steps in SEVERITY_STEPS.items():
        out[f"{name}_band"] = f"(x DOUBLE) RETURNS INT RETURN {_band(steps)}"
    return out


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session (replacing earlier ones); returns their names."""
    known = definitions()
    for name, text in known.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{text}")
    return list(known)
