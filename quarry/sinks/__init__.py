"""Writers and output layouts.

Layouts are projections (lazy); writers are the actions. Fold sets are
written from the compact (row, fold) table: the train side of fold f is a
filter ``fold <> f`` evaluated while writing, so the (k-1)x copy is never
shuffled or held in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.labels import SENTIMENT_BINARY, map_labels


def _csv(writer, sep: str = ",", header: bool = True):
    """Writer options shared by all delimited exports: minimal quoting (``"``
    doubled inside quoted fields), blanks at the ends of a field kept."""
    return (writer.option("sep", sep).option("header", str(header).lower())
            .option("quote", '"').option("escape", '"').option("quoteAll", "false").option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                    mode: str = "overwrite") -> None:
    """Minimal quoting (``"`` doubled inside quoted fields), optional header."""
    _csv(df.write.mode(mode), sep, header).csv(path)


def write_lines(df: DataFrame, path: str, col: str | None = None, mode: str = "overwrite") -> None:
    """One string per line."""
    c = col or df.columns[0]
    df.select(F.col(c).cast("string").alias("value")).write.mode(mode).text(path)


def fold_long_table(df: DataFrame, k: int, fold_col: str = "fold",
                    train_name: str = "train", val_name: str = "dev") -> DataFrame:
    """(fold, split, row) for every fold: the fold's own rows are ``val_name``,
    every other fold's rows ``train_name``. Built by ``explode`` of the k fold
    ids per row (no join), to be consumed by a partitioned write."""
    ids = F.sequence(F.lit(1), F.lit(k))
    exploded = df.withColumn("_q_f", F.explode(ids))
    split = F.when(F.col("_q_f") == F.col(fold_col), F.lit(val_name)).otherwise(F.lit(train_name))
    return exploded.withColumn("split", split).drop(fold_col).withColumnRenamed(
        "_q_f", fold_col)


def write_folds(df: DataFrame, path: str, k: int, fold_col: str = "fold", sep: str = "\t",
                header: bool = True, train_name: str = "train", val_name: str = "dev",
                mode: str = "overwrite") -> None:
    """``path/fold=i/split={train,dev}/part-*`` delimited files."""
    long = fold_long_table(df, k, fold_col, train_name, val_name)
    _csv(long.write.mode(mode).partitionBy(fold_col, "split"), sep, header).csv(path)


def write_fold_table(df: DataFrame, path: str, k: int, fold_col: str = "fold", sep: str = "\t",
                     header: bool = True, train_name: str = "train", val_name: str = "dev",
                     mode: str = "overwrite") -> None:
    """K03 without copies: every row once, ``path/fold=i/part-*``, and a catalog
    (``path/sets``) that says which of these folders make up each of the k x 2
    sets: a fold's own folder is its ``val_name`` set, all others are its
    ``train_name`` set. ``sources.scan_folds`` reads the sets."""
    columns = [c for c in df.columns if c != fold_col]
    _csv(df.write.mode(mode).partitionBy(fold_col), sep, header).csv(path)
    folds = list(range(1, k + 1))
    sets = [(f, split, [g for g in folds if (g == f) == (split == val_name)], columns, sep, header)
            for f in folds for split in (train_name, val_name)]
    catalog = df.sparkSession.createDataFrame(sets, "fold bigint, split string, folds array<bigint>, columns array<string>, sep string, header boolean")
    catalog.coalesce(1).write.mode(mode).json(f"{path}/sets")


# Column names of the STS export.
STS_COLUMNS = ["index", "genre", "filename", "year", "old_index", "source1", "source2",
               "sentence1", "sentence2", "stance"]


def sts_layout(df: DataFrame, idx: str = "idx", source: str = "source", target: str = "target",
               label: str = "stance") -> DataFrame:
    """Index, six ``none`` columns, sentence1/2, stance."""
    none = [F.lit("none").alias(c) for c in STS_COLUMNS[1:7]]
    return df.select(F.col(idx).alias("index"), *none, F.col(source).alias("sentence1"),
                     F.col(target).alias("sentence2"), F.col(label).alias("stance"))


def sst_layout(df: DataFrame, sentence: str = "source", sentiment: str = "sentiment",
               on_unknown: str = "error") -> DataFrame:
    """(sentence, label) with negative -> 0, neutral -> 1, others an error."""
    mapped = map_labels(df, sentiment, SENTIMENT_BINARY, out="_q_label", on_unknown=on_unknown)
    return mapped.select(F.col(sentence).alias("sentence"), F.col("_q_label").alias("label"))


def pair_layout(df: DataFrame, keep=()) -> DataFrame:
    """``id1-id2``, s1, s2, label (plus ``keep`` columns, e.g. split)."""
    return df.select(F.concat_ws("-", "id1", "id2").alias("pair_id"), "s1", "s2", "label", *keep)


# Placeholders of the event export.
URL_PLACEHOLDER = "PLEASE_ENTER_URL"
TITLE_PLACEHOLDER = "PLEASE_ENTER_TITLE"


def event_layout(df: DataFrame, ids_col: str = "post_ids") -> DataFrame:
    """(news_label, id, news_url, title, tweet_ids) for ``label:1`` (fake)
    and ``label:0`` (real) events; other labels are dropped."""
    side = F.when(F.col("label") == "label:1", F.lit("fake")).when(
        F.col("label") == "label:0", F.lit("real"))
    out = df.select(side.alias("news_label"), F.col("event_id").alias("id"),
                    F.lit(URL_PLACEHOLDER).alias("news_url"),
                    F.lit(TITLE_PLACEHOLDER).alias("title"),
                    F.translate(F.array_join(F.col(ids_col), "\t"), "\n", "").alias("tweet_ids"))
    return out.filter(F.col("news_label").isNotNull())


def write_events(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K07 write: one CSV set per side (``news_label=fake|real``)."""
    _csv(df.write.mode(mode).partitionBy("news_label")).csv(path)
