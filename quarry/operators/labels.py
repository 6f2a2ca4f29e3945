"""Label value maps (V01-V05) and the unknown-label filter.

The maps have a handful of entries, so they are literal ``map`` expressions:
the lookup runs inside the projection, with no join and no shuffle. Larger
user-supplied maps go through ``map_with_table`` (an equi-join Catalyst may
broadcast once it sees the table's size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label maps of the corpora.
RUMOUR_STANCE = {"support": "support", "deny": "deny", "comment": "comment"}
ARTICLE_STANCE = {"agree": "support", "disagree": "deny", "discuss": "comment",
                  "unrelated": "unrelated"}
RELATION = {"agree": "related", "disagree": "related", "discuss": "related",
            "unrelated": "unrelated"}
PARAPHRASE = {"(3, 2)": "paraphrases", "(4, 1)": "paraphrases", "(5, 0)": "paraphrases",
              "(1, 4)": "non_paraphrases", "(0, 5)": "non_paraphrases",
              "(2, 3)": "debatable"}
SENTIMENT_BINARY = {"negative": 0, "neutral": 1}

STANCE_DOMAIN = ["support", "deny", "comment", "unrelated"]
RELATION_DOMAIN = ["related", "unrelated"]


def lookup(col, mapping: dict) -> Column:
    """``mapping[col]`` as a literal map expression; NULL when absent."""
    c = F.col(col) if isinstance(col, str) else col
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), c) if pairs else F.lit(None)


def map_labels(df: DataFrame, col: str, mapping: dict, out: str | None = None,
               on_unknown: str = "drop") -> DataFrame:
    """Map ``col`` through ``mapping`` into ``out`` (default: in place).

    on_unknown: ``drop`` (row removed, F02), ``error`` (job fails on the first
    unknown value), ``null`` (kept as NULL)."""
    out = out or col
    c = F.col(col)
    known = c.isin(list(mapping))  # NULL is unknown too (isin gives NULL -> false)
    if on_unknown == "error":
        mapped = F.when(known, lookup(c, mapping)).otherwise(F.raise_error(
            F.concat(F.lit("Unrecognized label "), F.coalesce(c.cast("string"), F.lit("NULL")))))
        return df.withColumn(out, mapped)
    if on_unknown == "drop":
        return df.filter(known).withColumn(out, lookup(c, mapping))
    return df.withColumn(out, F.when(known, lookup(c, mapping)))


def map_with_table(df: DataFrame, col: str, table: DataFrame, key: str = "raw",
                   value: str = "mapped", out: str | None = None,
                   on_unknown: str = "drop") -> DataFrame:
    """Map through a (key, value) table with an equi-join; inner join drops
    unknown values, ``left`` keeps them as NULL."""
    out = out or col
    t = table.select(F.col(key).alias("_q_key"), F.col(value).alias("_q_val"))
    how = "inner" if on_unknown == "drop" else "left"
    joined = df.join(t, df[col] == t["_q_key"], how)
    return joined.withColumn(out, F.col("_q_val")).drop("_q_key", "_q_val")


def map_stance_rumour(df: DataFrame, col: str = "label", on_unknown: str = "drop") -> DataFrame:
    """V01."""
    return map_labels(df, col, RUMOUR_STANCE, on_unknown=on_unknown)


def map_stance_article(df: DataFrame, col: str = "stance", on_unknown: str = "drop") -> DataFrame:
    """agree/disagree/discuss/unrelated -> support/deny/comment/unrelated."""
    return map_labels(df, col, ARTICLE_STANCE, on_unknown=on_unknown)


def map_relation(df: DataFrame, col: str = "stance", on_unknown: str = "drop") -> DataFrame:
    """agree/disagree/discuss -> related, unrelated -> unrelated."""
    return map_labels(df, col, RELATION, on_unknown=on_unknown)


def map_paraphrase(df: DataFrame, col: str = "raw_label", out: str = "label",
                   on_unknown: str = "error") -> DataFrame:
    """Vote pairs to paraphrases / non_paraphrases / debatable."""
    return map_labels(df, col, PARAPHRASE, out=out, on_unknown=on_unknown)


def map_sentiment_binary(df: DataFrame, col: str = "sentiment", out: str = "label",
                         on_unknown: str = "error") -> DataFrame:
    """Negative -> 0, neutral -> 1, anything else is an error."""
    return map_labels(df, col, SENTIMENT_BINARY, out=out, on_unknown=on_unknown)


def drop_unknown_labels(df: DataFrame, col: str, mapping_or_domain) -> DataFrame:
    """keep rows whose label maps (or lies in a domain list)."""
    keys = list(mapping_or_domain)
    return df.filter(F.col(col).isin(keys))
