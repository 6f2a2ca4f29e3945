"""Set operations over datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_datasets(first: DataFrame, second: DataFrame, ordinal_col: str = "dataset") -> DataFrame:
    """Concatenate two labelled-pair datasets (features with features,
    labels with labels, D02); ``ordinal_col`` (0, 1) keeps the order."""
    return (first.withColumn(ordinal_col, F.lit(0))
            .unionByName(second.withColumn(ordinal_col, F.lit(1))))


def union_batches(frames: Sequence[DataFrame], ordinal_col: str = "ordinal") -> DataFrame:
    """Concatenate many frames in order (by name, missing columns NULL)."""
    out = None
    for i, f in enumerate(frames):
        f = f.withColumn(ordinal_col, F.lit(i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def union_label_classes(fake: DataFrame, real: DataFrame, label_col: str = "news_label") -> DataFrame:
    """Fake rows then real rows, tagged by side."""
    return (fake.withColumn(label_col, F.lit("fake"))
            .unionByName(real.withColumn(label_col, F.lit("real"))))
