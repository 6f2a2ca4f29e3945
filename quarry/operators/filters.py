"""Row filters (F01, F03-F08). All are native predicates, so they sit right
after the scan and reach Parquet as pushed filters where the column allows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import has_text
from quarry.operators.indexing import global_index


def drop_blank_pairs(df: DataFrame, text_cols: Sequence[str] = ("source", "target")) -> DataFrame:
    """keep rows whose texts all have a non-whitespace character
    (stance: source and target; sentiment: source only)."""
    cond = None
    for c in text_cols:
        cond = has_text(c) if cond is None else cond & has_text(c)
    return df.filter(cond)


def keep_clean_rows(df: DataFrame, clean_col: str = "clean") -> DataFrame:
    """``clean == 1``."""
    return df.filter(F.col(clean_col) == 1)


def drop_report_rows(df: DataFrame, stance_col: str = "stance") -> DataFrame:
    """drop ``report`` stances, then rows whose other columns are all NULL
    (both steps always run, D12)."""
    kept = df.filter(F.col(stance_col).isNull() | (F.col(stance_col) != "report"))
    others = [c for c in df.columns if c != stance_col]
    return kept.na.drop(how="all", subset=others) if others else kept


def keep_comment_sentiment(df: DataFrame, clean_col: str = "clean", stance_col: str = "stance",
                           sentiment_col: str = "sentiment") -> DataFrame:
    """clean rows with stance ``comment`` and a non-empty sentiment."""
    s = F.col(sentiment_col)
    return df.filter((F.col(clean_col) == 1) & (F.col(stance_col) == "comment")
                     & s.isNotNull() & (s != ""))


def keep_nonempty_urls(df: DataFrame, urls_col: str = "urls",
                       url_field: str | None = "expanded_url", out: str = "url") -> DataFrame:
    """one row per mentioned URL of posts that have any, URLs of length > 0.

    ``urls_col`` is an array of structs (``url_field``) or of strings."""
    exploded = df.withColumn(out, F.explode(F.col(urls_col)))
    if url_field:
        exploded = exploded.withColumn(out, F.col(f"{out}.{url_field}"))
    return exploded.filter(F.length(F.col(out)) > 0)


def batch_window(df: DataFrame, group_col: str, order_by: Sequence[str],
                 lo: int | None, hi: int | None, partition_col: str | None = None,
                 counted: DataFrame | None = None) -> DataFrame:
    """the article loader's ``batch_range=(lo, hi)``.

    Posts are numbered from 0 in article order (per ``partition_col``, e.g.
    the news label, which the reference loads one at a time). A post is kept
    when its number is > lo and its article started at a number <= hi, so an
    article in progress is finished. ``None`` bounds keep every row (D01).
    ``counted``: the rows of ``df`` that are numbered, where others may lie
    between them (within the window those stay, for a later join to leave out)."""
    if lo is None and hi is None:
        return df
    # only keys are numbered; what bounds the window comes back as one row of keys per part,
    # of which there are few, and goes to the rows: none is shuffled by its part
    part = F.col(partition_col) if partition_col else F.lit(0)
    keys = (df if counted is None else counted).select(part.alias("_q_part"), F.col(group_col).alias("_q_group"), F.struct(*order_by).alias("_q_key"))
    ranked = global_index(keys, ["_q_part", "_q_key"], out="_q_gpos")
    firsts = ranked.groupBy("_q_part").agg(F.min("_q_gpos").alias("_q_base"))
    ranked = ranked.join(F.broadcast(firsts), "_q_part").withColumn("_q_pos", F.col("_q_gpos") - F.col("_q_base"))
    starts = ranked.groupBy("_q_part", "_q_group").agg(F.min("_q_pos").alias("_q_start"))
    tagged = df.withColumns({"_q_part": part, "_q_key": F.struct(*order_by)})
    if lo is not None and lo >= 0:
        after = ranked.filter(F.col("_q_pos") == lo).select("_q_part", F.col("_q_key").alias("_q_after"))
        tagged = tagged.join(F.broadcast(after), "_q_part").filter(F.col("_q_key") > F.col("_q_after"))
    if hi is not None:
        begun = starts.filter(F.col("_q_start") <= hi)
        if order_by[0] == group_col:  # articles lie one behind the other: the last one that begins in time bounds them
            last = begun.groupBy("_q_part").agg(F.max(F.struct("_q_group")).alias("_q_last"))
            tagged = tagged.join(F.broadcast(last), "_q_part").filter(F.struct(F.col(group_col).alias("_q_group")) <= F.col("_q_last"))
        else:
            tagged = tagged.join(begun, (tagged["_q_part"] == begun["_q_part"]) & tagged[group_col].eqNullSafe(begun["_q_group"]), "left_semi")
    return tagged.select(*df.columns)


def cap_list_per_event(df: DataFrame, ids_col: str = "post_ids", n: int | None = 50) -> DataFrame:
    """first ``n`` ids of each event's list (``None`` keeps all)."""
    if n is None:
        return df
    return df.withColumn(ids_col, F.slice(F.col(ids_col), 1, n))
