"""End-to-end pipelines (P01-P19): raw tables to train / test / fold sets in
one lazy plan. Each returns a DataFrame; writing it (``sinks``) is the action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import flatten_newlines, py_rstrip
from quarry.operators import filters, indexing, joins, labels
from quarry.operators import text as text_ops

SPLIT_COLUMNS = ["idx", "source", "target", "stance", "split", "fold"]


def stance_pairs(stances: DataFrame, bodies: DataFrame, mapping: dict = labels.ARTICLE_STANCE,
                 paragraphs: bool = False) -> DataFrame:
    """S10 -> V02/V03 -> J01 -> V06 (or C10): (doc_id, source, target, label)."""
    return _with_bodies(labels.map_labels(stances, "stance", mapping, on_unknown="drop"), bodies, paragraphs)


def _with_bodies(mapped: DataFrame, bodies: DataFrame, paragraphs: bool = False) -> DataFrame:
    joined = joins.join_stance_bodies(mapped, bodies, strict=True)
    if paragraphs:
        return text_ops.explode_paragraphs(joined, "source", order_out="para")
    return joined.withColumn("source", flatten_newlines("source"))


def indexed_pairs(stances: DataFrame, bodies: DataFrame, mapping: dict, order_by, start: int,
                  total_out: str | None = None) -> DataFrame:
    """``stance_pairs`` with a dense index (idx). Every stance row has exactly one
    body, so the rows are numbered before the bodies are joined: in place where
    they stand in files (``order_by`` is their position), on the stance rows
    alone otherwise. No body passes through a shuffle for its number."""
    mapped = labels.map_labels(stances, "stance", mapping, on_unknown="drop")
    numbered = indexing.dense_index(mapped, order_by, out="idx", start=start, total_out=total_out)
    return _with_bodies(numbered, bodies).withColumnRenamed("label", "stance")


def split_labelled(df: DataFrame, idx_col: str = "idx", label_col: str = "stance",
                   text_cols=("source", "target"), k: int = 10, test_fraction: float = 0.05,
                   seed: int = 9) -> DataFrame:
    """F01 -> V08 -> W02 -> W01: the text-classification split of the reference."""
    kept = filters.drop_blank_pairs(df, list(text_cols))
    kept = kept.withColumn(label_col, py_rstrip(label_col))
    return indexing.holdout_split(kept, idx_col, test_fraction=test_fraction, seed=seed, k=k)


def pipeline_stance(stances: DataFrame, bodies: DataFrame, k: int = 10, order_by="doc_id") -> DataFrame:
    """Stance corpus -> 0-based index -> blank filter -> 5 % hold-out ->
    10 contiguous folds over the shuffled train part. ``order_by="position"``
    takes the order of the files (``scan_stance_corpus``)."""
    indexed = indexed_pairs(stances, bodies, labels.ARTICLE_STANCE, order_by, 0)
    return split_labelled(indexed, k=k).select(*SPLIT_COLUMNS)


def pipeline_stance_paragraphs(stances: DataFrame, bodies: DataFrame,
                               mapping: dict = labels.ARTICLE_STANCE, k: int = 10, order_by="doc_id") -> DataFrame:
    """P02 (and P03 paragraphs with the relation map): paragraphs of each body,
    1-based index in (row, paragraph) order, k contiguous folds. Paragraphs are
    counted per row; the sums of the counts before each row number them, so
    neither bodies nor paragraphs are sorted for it."""
    mapped = labels.map_labels(stances, "stance", mapping, on_unknown="drop")
    numbered = indexing.dense_index(mapped, order_by, out="_q_row")
    sizes = bodies.withColumn("_q_n", text_ops.paragraph_count("body"))
    counted = joins.join_stance_bodies(numbered, sizes, body_col="_q_n").withColumnsRenamed(
        {"source": "_q_n", "target": "headline", "label": "stance"})
    offsets = indexing.global_offsets(counted, "_q_row", "_q_n", out="_q_before", total_out="_q_total")
    rows = joins.join_stance_bodies(offsets.drop("_q_n"), bodies)
    parts = text_ops.explode_paragraphs(rows, "source", order_out="para", nth_out="_q_nth")
    place = F.col("_q_before") + F.col("_q_nth")
    return parts.select((place + 1).alias("idx"), "source", "target", F.col("label").alias("stance"),
                        indexing.fold_of(place, "_q_total", k).alias("fold"))


def pipeline_full_folds(stances: DataFrame, bodies: DataFrame,
                        mapping: dict = labels.ARTICLE_STANCE, k: int = 10, order_by="doc_id") -> DataFrame:
    """Whole bodies (newlines flattened), 1-based index, k folds."""
    pairs = indexed_pairs(stances, bodies, mapping, order_by, 1, total_out="_q_n")
    fold = indexing.fold_of(F.col("idx") - 1, "_q_n", k)
    return pairs.select("idx", "source", "target", "stance", fold.alias("fold"))


def cross_eval(df: DataFrame, order_by, k: int = 10, idx_col: str | None = None) -> DataFrame:
    """``export_cross_eval``: index (given ids, else 1..n in order) and the
    contiguous fold of every row."""
    ranked = indexing.global_index(df, order_by, out="_q_pos", total_out="_q_n")
    idx = F.col(idx_col) if idx_col else (F.col("_q_pos") + 1)
    out = ranked.withColumn("fold", indexing.fold_of("_q_pos", "_q_n", k)).withColumn("idx", idx)
    return out.select("idx", "source", "target", "stance", "fold")


def annotated_stance(batches: DataFrame, clean_text=None) -> DataFrame:
    """S11 -> F04 -> F03 -> V07 -> [C01] -> U02 -> W04: (idx, source, target, stance)."""
    from quarry.functions.text import simple_clean
    df = filters.drop_report_rows(batches.select("batch", "news_label", "doc_id", "source",
                                                 "target", "stance", "clean"))
    df = filters.keep_clean_rows(df)
    df = df.withColumn("source", simple_clean("source")).withColumn("target", simple_clean("target"))
    if clean_text is not None:
        df = clean_text(df, "source")
    df = df.withColumn("_q_ord", F.struct("batch", "news_label", "doc_id"))
    dedup = indexing.drop_duplicate_pairs(df.select("_q_ord", "source", "target", "stance"),
                                          ["source", "target"], "_q_ord", idx_out="idx", start=1)
    return dedup.select("idx", "source", "target", "stance")


def annotated_sentiment(batches: DataFrame, clean_text=None) -> DataFrame:
    """S11 -> F05 -> V07 -> [C01] -> U02 -> W04(source): (idx, source, sentiment)."""
    from quarry.functions.text import simple_clean
    df = filters.keep_comment_sentiment(batches)
    df = df.withColumn("source", simple_clean("source"))
    if clean_text is not None:
        df = clean_text(df, "source")
    df = df.withColumn("_q_ord", F.struct("batch", "news_label", "doc_id"))
    dedup = indexing.drop_duplicate_pairs(df.select("_q_ord", "source", "sentiment"),
                                          ["source"], "_q_ord", idx_out="idx", start=1)
    return dedup.select("idx", "source", "sentiment")


def pipeline_annotated_stance(batches: DataFrame, clean_text=None, k: int = 10) -> DataFrame:
    """Annotated stance batches -> dedupe -> hold-out -> folds."""
    out = split_labelled(annotated_stance(batches, clean_text), k=k)
    return out.select(*SPLIT_COLUMNS)


def pipeline_annotated_sentiment(batches: DataFrame, clean_text=None, k: int = 10) -> DataFrame:
    """Annotated sentiment batches -> dedupe -> hold-out -> folds."""
    out = split_labelled(annotated_sentiment(batches, clean_text), label_col="sentiment",
                         text_cols=("source",), k=k)
    return out.select("idx", "source", "sentiment", "split", "fold")


def pipeline_paraphrase(rows: DataFrame, clean_text=None, k: int = 10) -> DataFrame:
    """Every row kept -> C01 on both sentences -> V04 (strict) ->
    0-based index in file order -> blank filter -> hold-out -> folds.

    ``rows``: (doc_id order key, sent1, sent2, raw_label)."""
    df = rows
    if clean_text is not None:
        # the second sentences repeat across rows: clean each distinct one once
        df = clean_text(clean_text(df, "sent1"), "sent2", by_value=True)
    df = labels.map_paraphrase(df, "raw_label", out="label", on_unknown="error")
    df = indexing.global_index(df, "doc_id", out="idx", start=0)
    out = split_labelled(df.select("idx", "sent1", "sent2", "label"), label_col="label",
                         text_cols=("sent1", "sent2"), k=k)
    return out.select("idx", "sent1", "sent2", "label", "split", "fold")


def pipeline_article_posts(articles: DataFrame, posts: DataFrame, vocab: DataFrame | None = None,
                           batch_range: tuple[int, int] | None = None, costs: DataFrame | None = None) -> DataFrame:
    """Articles x posts -> (post, title) / (post, description) rows,
    ``comment`` label, 0-based index per news label (the reference exports one
    file per label). ``batch_range`` counts the posts of articles that have a
    content row, before they are joined and cleaned.

    With ``vocab`` (and the segmentation's ``costs``) the cleaned variant runs: posts, titles and descriptions
    go through C01 and each post loses what it quotes from its target (C09)."""
    from quarry.operators import cleaning
    keys = [c for c in joins.ARTICLE_KEYS if c in articles.columns and c in posts.columns]
    if batch_range is not None:
        # the keys alone tell the window; posts without an article fall out in the join
        counted = posts.select(*keys, "post_id").join(articles.select(*keys).distinct(), keys, "left_semi")
        posts = filters.batch_window(posts, "news_id", ["news_id", "post_id"], batch_range[0],
                                     batch_range[1], partition_col="news_label", counted=counted)
    if vocab is not None:
        clean = cleaning.corpus_cleaner(vocab, "news_id", costs)
        articles = articles.withColumn("_q_art", F.struct(*keys))
        articles = clean(clean(articles, "title", key="_q_art"), "description", key="_q_art")
        posts = posts.withColumn("_q_post", F.struct(*keys, "post_id"))
        posts = clean(posts, "post", key="_q_post").drop("_q_post")
    else:
        posts = posts.withColumn("post", flatten_newlines("post"))
    # without the post beside the source made of it: what follows moves every column
    pairs = joins.join_articles_posts(articles, posts, keys).select(
        "news_label", "news_id", "post_id", "target_kind", "source", "target", "label")
    if vocab is not None:
        # written once: the range shuffle below reads its input twice
        pairs = indexing.stage(cleaning.remove_quoted_overlap(pairs, "source", "target"))
    ranked = indexing.group_row_number(pairs, ["news_label"], ["news_id", "post_id", "target_kind"],
                                       out="idx", start=0)
    return ranked.select("news_label", "idx", "source", "target", F.col("label").alias("stance"))


def pipeline_rumour_threads(edges: DataFrame, posts: DataFrame, thread_labels: DataFrame,
                            headlines: DataFrame, k: int = 10) -> DataFrame:
    """Source x headline rows (J04), reply -> parent rows (J03) and
    propagated reply -> headline rows (J05); stance-domain check; 1-based
    index and k folds in (thread, node, part, target) order."""
    from quarry.operators import quality, threads
    j04 = threads.join_source_headlines(posts, thread_labels, headlines).select(
        "thread", F.col("post").alias("node"), F.lit(0).alias("part"), "source", "target", "label")
    j03 = threads.join_thread_pairs(edges, posts, thread_labels).select(
        "thread", "node", F.lit(1).alias("part"), "source", "target", "label")
    j05 = threads.propagate_headline_labels(edges, posts, thread_labels, headlines).select(
        "thread", "node", F.lit(2).alias("part"), "source", "target", "label")
    rows = j04.unionByName(j03).unionByName(j05).withColumnRenamed("label", "stance")
    rows = quality.require_label_domain(rows, labels.STANCE_DOMAIN, "stance")
    return cross_eval(rows, ["thread", "node", "part", "target"], k)


def pipeline_url_analysis(articles: DataFrame, posts: DataFrame) -> DataFrame:
    """The three outputs of the url analysis, told apart by ``output``:
    ``mentions`` (A01: the sites that each article's posts mention, for all
    articles with posts), ``mentioned`` (A02: sites by the number of articles that
    mention them) and ``sources`` (A03: sites by the number of articles
    they published), the last two with their rank by frequency (T01)."""
    from quarry.operators import aggregates as agg
    keys = [c for c in joins.ARTICLE_KEYS if c in posts.columns]
    urls = filters.keep_nonempty_urls(posts, "urls")
    lists = agg.mentioned_urls_by_event(posts, urls, keys)
    mentioned = agg.order_by_frequency(agg.mentioned_url_frequency(urls, keys), "frequency", "mentioned_url", rank_out="rank")
    published = agg.order_by_frequency(agg.source_url_frequency(articles), "frequency", "source_url", rank_out="rank")
    none = F.lit(None)

    def rows(df, output, news_id, urls, label, frequency, rank):
        return df.select(F.lit(output).alias("output"), news_id.cast("string").alias("news_id"), urls.alias("urls"),
                         label.cast("string").alias("label"), frequency.cast("bigint").alias("frequency"), rank.cast("bigint").alias("rank"))
    return (rows(lists, "mentions", F.col("news_id"), F.col("mentioned_urls"), F.col("news_label"), none, none)
            .unionByName(rows(mentioned, "mentioned", none, F.col("mentioned_url"), F.col("label"), F.col("frequency"), F.col("rank")))
            .unionByName(rows(published, "sources", none, F.col("source_url"), none, F.col("frequency"), F.col("rank"))))


def pipeline_sentence_pairs(pairs: DataFrame, dev_ids: DataFrame, test_pairs: DataFrame) -> DataFrame:
    """The pairs of the training file as ``train`` or, if listed, ``dev``, and
    those of the test file as ``test``; K06 layout with split."""
    split = joins.pair_semi_anti_split(pairs, dev_ids).select("label", "id1", "id2", "s1", "s2", "split")
    test = test_pairs.select("label", "id1", "id2", "s1", "s2").withColumn("split", F.lit("test"))
    from quarry import sinks
    return sinks.pair_layout(split.unionByName(test), keep=("split",))
