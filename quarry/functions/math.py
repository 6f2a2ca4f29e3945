"""Array math expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def softmax(col) -> Column:
    """Numerically stable softmax of an array<double> column."""
    x = F.col(col) if isinstance(col, str) else col
    shifted = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
    total = F.aggregate(shifted, F.lit(0.0).cast("double"), lambda acc, v: acc + v)
    return F.transform(shifted, lambda v: v / total)


def argmax(col) -> Column:
    """0-based position of the first maximum of an array column."""
    x = F.col(col) if isinstance(col, str) else col
    return (F.array_position(x, F.array_max(x)) - 1).cast("bigint")
