"""Aggregations: mentioned sites (A01-A03), label histogram (A08),
frequency order (T01). All are hash aggregates with map-side partial
aggregation, so a site or label holding a third of the rows is reduced
inside each map task before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.web import home_url
from quarry.operators.indexing import global_index


def mentioned_urls_by_event(articles: DataFrame, urls: DataFrame, key=("news_label", "news_id"),
                            url_col: str = "url") -> DataFrame:
    """Per article, its distinct mentioned home URLs, sorted and
    space-joined; an article with no URL gives ''.

    ``urls`` has one row per (article, URL) mention (after F06); the distinct
    step runs before the list is built, so the list holds distinct sites only."""
    key = list(key)
    homes = urls.select(*key, home_url(F.col(url_col)).alias("_q_home")).distinct()
    per = homes.groupBy(*key).agg(
        F.array_join(F.array_sort(F.collect_list("_q_home")), " ").alias("mentioned_urls"))
    out = articles.select(*key).distinct().join(per, key, "left")
    return out.select(*key, F.coalesce(F.col("mentioned_urls"), F.lit("")).alias("mentioned_urls"))


def mentioned_url_frequency(urls: DataFrame, key=("news_label", "news_id"), url_col: str = "url",
                            label_col: str = "news_label") -> DataFrame:
    """Per home URL, the number of articles mentioning it (fake + real),
    and which side mentions it more (``fake``/``real``/``tie``)."""
    key = list(key)
    homes = urls.select(*key, home_url(F.col(url_col)).alias("mentioned_url")).distinct()
    g = homes.groupBy("mentioned_url").agg(
        F.count(F.lit(1)).alias("frequency"),
        F.sum(F.when(F.col(label_col) == "fake", 1).otherwise(0)).alias("_q_fake"),
        F.sum(F.when(F.col(label_col) == "real", 1).otherwise(0)).alias("_q_real"))
    label = (F.when(F.col("_q_fake") > F.col("_q_real"), F.lit("fake"))
             .when(F.col("_q_fake") < F.col("_q_real"), F.lit("real")).otherwise(F.lit("tie")))
    return g.select("mentioned_url", F.col("frequency").cast("bigint"), label.alias("label"))


def source_url_frequency(articles: DataFrame, url_col: str = "url") -> DataFrame:
    """Number of articles per source home URL."""
    return articles.groupBy(home_url(F.col(url_col)).alias("source_url")).agg(
        F.count(F.lit(1)).cast("bigint").alias("frequency"))


def label_histogram(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows per label."""
    return df.groupBy(F.col(label_col).alias("label")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def order_by_frequency(df: DataFrame, freq_col: str = "frequency", key_col: str = "mentioned_url",
                       rank_out: str | None = "rank") -> DataFrame:
    """Descending frequency, ties by key (D06). With ``rank_out`` the
    order is materialized as a 1-based dense position (G01)."""
    if rank_out is None:
        return df.orderBy(F.col(freq_col).desc(), F.col(key_col).asc())
    return global_index(df, [F.col(freq_col).desc(), F.col(key_col).asc()], out=rank_out, start=1)
