"""Join helpers shared by the jobs."""

from __future__ import annotations

from pyspark.sql import functions as F


def numeric_key(col: str | F.Column) -> F.Column:
    """Dimension ids compared as numbers, so ``07`` matches 7 (defect D18); text that is not a number
    gives null and matches nothing."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string").try_cast("bigint")
