"""Data-quality checks (Q01-Q03) as one aggregate pass each.

Each returns a report table; ``strict=True`` additionally fails the job from
inside the plan (``raise_error``) so no second pass is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _guard(report: DataFrame, count_col: str, message: str) -> DataFrame:
    return report.withColumn(count_col, F.when(F.col(count_col) == 0, F.col(count_col)).otherwise(
        F.raise_error(F.concat(F.lit(message + ": "), F.col(count_col).cast("string")))))


def validate_pairs(df: DataFrame, text_cols: Sequence[str] = ("source", "target"),
                   label_col: str = "label", strict: bool = False) -> DataFrame:
    """Q01: (rule, violations): both texts and the label present and STRING.

    Type rules are checked on the schema (a non-string column violates on
    every row); presence rules are counted in one aggregate."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(text_cols) + [label_col]
    aggs = []
    for c in cols:
        bad = F.col(c).isNull()
        if not isinstance(types.get(c), T.StringType):
            bad = F.lit(True)
        aggs.append(F.sum(F.when(bad, 1).otherwise(0)).cast("bigint").alias(c))
    counts = df.agg(*aggs)
    rules = F.array(*[F.struct(F.lit(f"{c}_present_string").alias("rule"),
                               F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("violations"))
                      for c in cols])
    report = counts.select(F.explode(rules).alias("r")).select("r.rule", "r.violations")
    return _guard(report, "violations", "pair validation failed") if strict else report


def validate_label_domain(df: DataFrame, domain: Sequence[str], label_col: str = "label",
                          strict: bool = False) -> DataFrame:
    """Q02: (label, violations) for labels outside ``domain``."""
    bad = df.filter(~F.coalesce(F.col(label_col).isin(list(domain)), F.lit(False)))
    report = bad.groupBy(F.col(label_col).alias("label")).agg(
        F.count(F.lit(1)).cast("bigint").alias("violations"))
    return _guard(report, "violations", "labels outside the domain") if strict else report


def require_label_domain(df: DataFrame, domain: Sequence[str], label_col: str = "label") -> DataFrame:
    """Q02 strict, in-line: the rows unchanged, but the job fails on the first
    label outside ``domain`` (the dataset constructor's assertion)."""
    c = F.col(label_col)
    return df.withColumn(label_col, F.when(c.isin(list(domain)), c).otherwise(F.raise_error(
        F.concat(F.lit("label outside the domain: "), F.coalesce(c.cast("string"), F.lit("NULL"))))))


def assert_equal_sizes(left: DataFrame, right: DataFrame, idx: str = "idx",
                       strict: bool = False) -> DataFrame:
    """Q03: indices present on one side only (idx, in_left, in_right); empty
    when the two tables line up."""
    l = left.select(idx).withColumn("in_left", F.lit(True))
    r = right.select(idx).withColumn("in_right", F.lit(True))
    j = l.join(r, idx, "full").select(idx, F.coalesce("in_left", F.lit(False)).alias("in_left"),
                                      F.coalesce("in_right", F.lit(False)).alias("in_right"))
    mism = j.filter(~(F.col("in_left") & F.col("in_right")))
    if strict:
        mism = mism.withColumn("in_left", F.raise_error(F.lit("tables differ in size")))
    return mism
