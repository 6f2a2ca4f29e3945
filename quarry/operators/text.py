"""Text jobs over corpus tables (C10 here; cleaning jobs in ``cleaning``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import has_text, split_lines


def _paragraphs(text_col: str):
    return F.filter(F.transform(split_lines(text_col), lambda text, i: F.struct(i.cast("bigint").alias("at"), text.alias("text"))),
                    lambda p: has_text(p["text"]))


def paragraph_count(text_col: str = "source"):
    """Number of rows that ``explode_paragraphs`` makes of a text."""
    return F.coalesce(F.size(_paragraphs(text_col)), F.lit(0)).cast("bigint")


def explode_paragraphs(df: DataFrame, text_col: str = "source",
                       order_out: str = "para", nth_out: str | None = None) -> DataFrame:
    """One row per non-blank line of ``text_col`` (``splitlines``), the
    other columns repeated; the paragraph text is not trimmed. ``order_out`` is
    the line's number among all lines, ``nth_out`` the one among those kept."""
    others = [c for c in df.columns if c != text_col]
    if nth_out is None:
        exploded = df.select(*others, F.posexplode(split_lines(text_col)).alias(order_out, text_col))
        return exploded.filter(has_text(text_col)).withColumn(order_out, F.col(order_out).cast("bigint"))
    exploded = df.select(*others, F.posexplode(_paragraphs(text_col)).alias(nth_out, "_q_p"))
    return exploded.select(*others, F.col(nth_out).cast("bigint").alias(nth_out), F.col("_q_p.at").alias(order_out), F.col("_q_p.text").alias(text_col))
