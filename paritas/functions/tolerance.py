"""Allowed differences: an absolute amount, or a percentage of the source value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def allowed(spec: str | int | float | None, base: Column) -> Column:
    """``"0"`` exact, ``"5"`` absolute, ``"0.1%"`` of ``base``; a double."""
    if spec is None:
        return F.lit(0.0)
    text = str(spec).strip()
    if text.endswith("%"):
        return F.coalesce(F.abs(base), F.lit(0)).cast("double") * F.lit(float(text[:-1]) / 100.0)
    return F.lit(float(text))
