"""Multi-class evaluation (U04, A04-A07) from one confusion aggregate.

The confusion table has at most (labels x labels) rows, so everything after
the first aggregate is tiny; the only pass over the predictions is the
partial/final hash aggregate of A04.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def label_union_set(df: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """Distinct union of predicted and true labels."""
    return (df.select(F.col(pred).alias("label"))
            .union(df.select(F.col(truth).alias("label"))).distinct())


def confusion_matrix(df: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """(truth, pred, n)."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def _per_label(cm: DataFrame) -> DataFrame:
    both = cm.select(F.explode(F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("t"),
                 F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0).alias("tp"),
                 F.lit(0).cast("bigint").alias("p")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("bigint").alias("t"),
                 F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("p")))).alias("x"))
    return both.groupBy(F.col("x.label").alias("label")).agg(
        F.sum("x.t").alias("support"), F.sum("x.tp").alias("tp"), F.sum("x.p").alias("predicted"))


def _ratio(num, den):
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def class_metrics(df: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """Per label precision, recall and F1 (0 where a denominator is 0)."""
    pl = _per_label(confusion_matrix(df, pred, truth))
    return pl.select(
        "label",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"))


def overall_metrics(df: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """Accuracy, micro and macro precision / recall / F1 (one row)."""
    pl = _per_label(confusion_matrix(df, pred, truth))
    per = pl.select(
        "tp", "support",
        _ratio(F.col("tp"), F.col("predicted")).alias("p"),
        _ratio(F.col("tp"), F.col("support")).alias("r"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f"))
    acc = _ratio(F.sum("tp"), F.sum("support"))
    return per.agg(
        acc.alias("accuracy"),
        acc.alias("micro_precision"),
        acc.alias("micro_recall"),
        acc.alias("micro_f1"),
        F.avg("p").alias("macro_precision"),
        F.avg("r").alias("macro_recall"),
        F.avg("f").alias("macro_f1"))


def metrics_report(df: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """``label, accuracy, precision, recall, f1``: one row per label
    (accuracy empty), then ``macro`` (with accuracy), then ``micro``.
    ``position`` keeps that row order (labels alphabetical, D05)."""
    cls = class_metrics(df, pred, truth).select(
        F.lit(0).alias("position"), "label", F.lit(None).cast("double").alias("accuracy"),
        "precision", "recall", "f1")
    ov = overall_metrics(df, pred, truth)
    macro = ov.select(F.lit(1).alias("position"), F.lit("macro").alias("label"), "accuracy",
                      F.col("macro_precision").alias("precision"),
                      F.col("macro_recall").alias("recall"), F.col("macro_f1").alias("f1"))
    micro = ov.select(F.lit(2).alias("position"), F.lit("micro").alias("label"),
                      F.lit(None).cast("double").alias("accuracy"),
                      F.col("micro_precision").alias("precision"),
                      F.col("micro_recall").alias("recall"), F.col("micro_f1").alias("f1"))
    return cls.unionByName(macro).unionByName(micro)
