"""Fixture views: the reference's input layouts derived from the shared tables.

Each function reads the parquet tables under ``sf_dir`` and shapes them into
one input of the corpus operators (FIXTURES.md, part 2). Everything is a lazy
DataFrame, so the fixture and the operator under test form one plan and the
work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.text import WS_CLASS
from quarry.functions.web import title_and_media

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Row count of a table (a driver-side scalar; Parquet footers answer it)."""
    return table(spark, sf_dir, name).count()


# --- stance corpus (article bodies + headline/stance rows) -------------------

def fx_stance_bodies(spark, sf_dir) -> DataFrame:
    """Bodies table of the stance corpus: (body_id, body, position)."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("body_id"), F.col("text").alias("body"), F.col("doc_id").alias("position"))


def _raw_stance(quality, toxic):
    return (F.when((quality == 1) & (toxic == 0), "agree")
            .when((quality == 1) & (toxic == 1), "discuss")
            .when((quality == 0) & (toxic == 0), "disagree")
            .when((quality == 0) & (toxic == 1), "unrelated"))


def fx_stance_rows(spark, sf_dir) -> DataFrame:
    """Stances table: (doc_id order key, headline, body_id, stance raw label)."""
    nb = row_count(spark, sf_dir, "benchmark")
    lab = table(spark, sf_dir, "labels")
    bench = table(spark, sf_dir, "benchmark").select(
        F.col("item_id"), F.col("text").alias("headline"))
    rows = lab.join(bench, F.col("doc_id") % F.lit(nb) == F.col("item_id"))
    return rows.select(F.col("doc_id"), F.col("headline"), F.col("doc_id").alias("body_id"),
                       _raw_stance(F.col("quality"), F.col("toxic")).alias("stance"))


def fx_stance_pairs(spark, sf_dir) -> DataFrame:
    """fx_stances joined: (doc_id, body, headline, raw_stance)."""
    nb = row_count(spark, sf_dir, "benchmark")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
    lab = table(spark, sf_dir, "labels")
    bench = table(spark, sf_dir, "benchmark").select(
        F.col("item_id"), F.col("text").alias("headline"))
    j = docs.join(lab, "doc_id").join(bench, F.col("doc_id") % F.lit(nb) == F.col("item_id"))
    return j.select("doc_id", "body", "headline",
                    _raw_stance(F.col("quality"), F.col("toxic")).alias("raw_stance"))


def fx_pairs_blank(spark, sf_dir) -> DataFrame:
    """(idx, source, target, label) with blank texts and padded labels."""
    st = fx_stance_pairs(spark, sf_dir)
    return st.select(
        F.col("doc_id").alias("idx"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("  ")).otherwise(F.col("body")).alias("source"),
        F.when(F.col("doc_id") % 13 == 0, F.lit("")).otherwise(F.col("headline")).alias("target"),
        F.concat(F.coalesce(F.col("raw_stance"), F.lit("none")), F.lit("  ")).alias("label"))


# --- rumour threads -------------------------------------------------------------

def _thread_label(conv_id, turn):
    h = conv_id * 7 + turn * 3
    return (F.when(h % 11 == 10, F.lit(None).cast("string"))
            .when((h % 6).isin(0, 1, 4), "support")
            .when((h % 6).isin(2, 3), "deny")
            .otherwise("comment"))


def fx_thread_posts(spark, sf_dir) -> DataFrame:
    """(thread, post, text, is_source)."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("thread"), F.col("turn").alias("post"),
                    F.col("text"), (F.col("turn") == 0).alias("is_source"))


def fx_thread_edges(spark, sf_dir, chains: bool = False) -> DataFrame:
    """(thread, parent, node): a branching tree, or chains with ``chains``."""
    c = table(spark, sf_dir, "conversations").filter(F.col("turn") > 0)
    parent = (F.col("turn") - 1) if chains else F.floor((F.col("turn") - 1) / 2)
    return c.select(F.col("conv_id").alias("thread"), parent.cast("bigint").alias("parent"),
                    F.col("turn").alias("node"))


def fx_thread_labels(spark, sf_dir) -> DataFrame:
    """(thread, post, label) for posts present in the label map."""
    c = table(spark, sf_dir, "conversations")
    lab = c.select(F.col("conv_id").alias("thread"), F.col("turn").alias("post"),
                   _thread_label(F.col("conv_id"), F.col("turn")).alias("label"))
    return lab.filter(F.col("label").isNotNull())


def fx_thread_dev_labels(spark, sf_dir) -> DataFrame:
    """A second (dev) label map: turns divisible by 3, labelled with a shifted hash."""
    c = table(spark, sf_dir, "conversations").filter(F.col("turn") % 3 == 0)
    lab = c.select(F.col("conv_id").alias("thread"), F.col("turn").alias("post"),
                   _thread_label(F.col("conv_id"), F.col("turn") + 1).alias("label"))
    return lab.filter(F.col("label").isNotNull())


def fx_page_headlines(spark, sf_dir) -> DataFrame:
    """Headline table from stored pages (V11): url_id, full_url, headline, media, clean."""
    p = table(spark, sf_dir, "pages")
    headline, media = title_and_media(F.col("html"))
    return p.select(F.col("page_id").alias("url_id"), F.col("url").alias("full_url"),
                    headline.alias("headline"), media.alias("media"), F.lit("1").alias("clean"))


def fx_thread_manifest(spark, sf_dir) -> DataFrame:
    """Per thread URL manifest: (thread, url_id, short_url, full_url)."""
    npages = row_count(spark, sf_dir, "pages")
    threads = table(spark, sf_dir, "conversations").filter(F.col("turn") == 0).select(
        F.col("conv_id").alias("thread"))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id"), F.col("url"))
    j = threads.join(pages, F.col("thread") % F.lit(npages) == F.col("page_id"))
    return j.select("thread", F.col("page_id").alias("url_id"), F.lit("").alias("short_url"),
                    F.col("url").alias("full_url"))


def fx_reply_json(spark, sf_dir) -> DataFrame:
    """Per conversation, its whole reply tree (fx_threads shape) as nested JSON
    text; a post without replies maps to ``[]``.

    Built bottom-up, one tree level per step: each level groups the JSON of
    its nodes by parent (a parent has at most two children here), so no
    thread is ever collected into one row before its JSON text itself."""
    c = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("thread"), F.col("turn").alias("node"))
    depth = F.floor(F.log2(F.col("node") + 1)).cast("int")
    nodes = c.withColumn("depth", depth).withColumn(
        "parent", F.when(F.col("node") > 0, F.floor((F.col("node") - 1) / 2)).cast("bigint"))
    max_depth = nodes.agg(F.max("depth")).first()[0] or 0
    done = None  # (thread, node, json) for the level below
    for d in range(max_depth, -1, -1):
        level = nodes.filter(F.col("depth") == d).select("thread", "node", "parent")
        if done is None:
            level = level.withColumn("json", F.lit("[]"))
        else:
            kids = done.groupBy("thread", F.col("parent").alias("node")).agg(
                F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list(
                    F.struct("child", "json"))), lambda k: F.concat(
                        F.lit('"'), k["child"].cast("string"), F.lit('": '), k["json"])), ", "),
                    F.lit("}")).alias("json"))
            level = level.join(kids, ["thread", "node"], "left").withColumn(
                "json", F.coalesce(F.col("json"), F.lit("[]")))
        done = level.select("thread", F.col("node").alias("child"), "parent", "json")
        done = done.checkpoint(eager=True) if d % 4 == 0 else done
    roots = done.filter(F.col("parent").isNull())
    return roots.select("thread", F.concat(F.lit('{"'), F.col("child").cast("string"), F.lit('": '),
                                           F.col("json"), F.lit("}")).alias("structure"))


# --- articles, posts and mentioned URLs -------------------------------------------

def article_count(spark, sf_dir) -> int:
    """Number of article ids: it grows with the pages."""
    return row_count(spark, sf_dir, "pages") // 10 + 10


def _side(news_id):
    return F.when(news_id % 20 < 11, "fake").otherwise("real")


def fx_mentions(spark, sf_dir) -> DataFrame:
    """Posts with entity URLs: (news_label, news_id, post_id, urls array<struct>)."""
    p = table(spark, sf_dir, "pages")
    news_id = F.col("page_id") % F.lit(article_count(spark, sf_dir))
    return p.select(
        _side(news_id).alias("news_label"),
        news_id.cast("bigint").alias("news_id"), F.col("page_id").alias("post_id"),
        F.array(F.struct(F.col("url").alias("expanded_url"))).alias("urls"))


def fx_articles(spark, sf_dir) -> DataFrame:
    """Articles: (news_label, news_id, url, title, description)."""
    p = table(spark, sf_dir, "pages")
    first = p.groupBy((F.col("page_id") % F.lit(article_count(spark, sf_dir))).alias("news_id")).agg(
        F.min_by(F.struct(F.col("url"), F.col("html")), F.col("page_id")).alias("pg"))
    bench = table(spark, sf_dir, "benchmark").select(F.col("item_id"), F.col("text"))
    arts = first.join(bench, F.col("news_id") == F.col("item_id"), "left")
    title, _ = title_and_media(F.col("pg.html"))
    return arts.select(
        _side(F.col("news_id")).alias("news_label"),
        F.col("news_id").cast("bigint").alias("news_id"), F.col("pg.url").alias("url"),
        title.alias("title"),
        F.when(F.col("news_id") % 4 == 0, F.lit("")).otherwise(F.coalesce(F.col("text"), F.lit("")))
        .alias("description"))


def fx_article_posts(spark, sf_dir) -> DataFrame:
    """Posts of articles: (news_label, news_id, post_id, post) = whole document texts."""
    d = table(spark, sf_dir, "documents")
    news_id = F.col("doc_id") % F.lit(article_count(spark, sf_dir))
    return d.select(_side(news_id).alias("news_label"), news_id.cast("bigint").alias("news_id"),
                    F.col("doc_id").alias("post_id"), F.col("text").alias("post"))


def fx_url_text(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    headline, _ = title_and_media(F.col("html"))
    return p.select(F.col("page_id"), F.concat(F.lit("see "), F.col("url"), F.lit(" via "),
                                                headline).alias("text"))


# --- annotated batches -----------------------------------------------------------

def fx_annotated(spark, sf_dir) -> DataFrame:
    """(batch, news_label, doc_id, source, target, stance, sentiment, clean)."""
    nb = row_count(spark, sf_dir, "benchmark")
    d = table(spark, sf_dir, "documents")
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("target"))
    j = d.join(bench, F.col("doc_id") % F.lit(nb) == F.col("item_id"))
    return j.select(
        F.col("source").alias("batch"),
        F.when(F.col("doc_id") % 2 == 0, "fake").otherwise("real").alias("news_label"),
        F.col("doc_id"), F.col("text").alias("source"), F.col("target"),
        F.element_at(F.array(*[F.lit(s) for s in ("support", "deny", "comment", "report")]),
                     (F.col("doc_id") % 4 + 1).cast("int")).alias("stance"),
        F.when(F.col("doc_id") % 3 == 0, "negative").when(F.col("doc_id") % 3 == 1, "neutral")
        .alias("sentiment"),
        F.when(F.col("doc_id") % 5 != 0, 1).otherwise(0).cast("int").alias("clean"))


# --- event lines, sentence pairs, paraphrases --------------------------------------

def fx_event_lines(spark, sf_dir) -> DataFrame:
    """``eid:<id>\\tlabel:<l>\\t<ids...>`` text lines, one per customer.

    The line is the corpus' input format: it holds the whole id list of an
    event, so it is built once per customer from a sorted list."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    g = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("ids"))
    line = F.concat(F.lit("eid:"), F.col("o_custkey").cast("string"), F.lit("\t"),
                    F.lit("label:"), (F.col("o_custkey") % 3).cast("string"), F.lit("\t"),
                    F.array_join(F.col("ids").cast("array<string>"), " "))
    return g.select(line.alias("value"))


#: Ids that differ in these last bits only are a run; the texts of a run meet in one task.
_RUN_BITS = 6


def fx_pair_lines(spark, sf_dir) -> DataFrame:
    """Sentence-pair file lines ``label\\tid1\\tid2\\ts1\\ts2`` (value column).

    Each text is shuffled once, to the run of its id, and the first id of a run
    to the run before it too, whose last id it follows; there each id finds all
    texts of the next one. Lines come out by id within a run."""
    d = table(spark, sf_dir, "documents").filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("id1"), F.struct(F.regexp_replace("text", f"{WS_CLASS}+", " ").alias("text")).alias("s1"))  # a list keeps a struct, also of null
    run = F.shiftright("id1", _RUN_BITS)
    begins = F.col("id1").bitwiseAND(F.lit((1 << _RUN_BITS) - 1)) == 0
    own, before = F.struct(run.alias("run"), F.lit(True).alias("own")), F.struct((run - 1).alias("run"), F.lit(False).alias("own"))
    d = d.select("id1", "s1", F.inline(F.when(begins, F.array(own, before)).otherwise(F.array(own))))
    following = Window.partitionBy("run").orderBy("id1").rangeBetween(1, 1)
    j = d.withColumn("next", F.collect_list("s1").over(following))  # the column itself: an expression of it would be shuffled beside it
    j = j.filter("own").select("id1", (F.col("id1") + 1).alias("id2"), F.col("s1.text").alias("s1"), F.inline("next").alias("s2"))
    line = F.concat_ws("\t", (F.col("id1") % 2).cast("string"), F.col("id1").cast("string"),
                       F.col("id2").cast("string"), F.col("s1"), F.col("s2"))
    return j.select(line.alias("value"))


def fx_dev_ids(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id")
    return d.filter(F.col("doc_id") % 10 == 3).select(
        F.col("doc_id").cast("string").alias("id1"),
        (F.col("doc_id") + 1).cast("string").alias("id2"))


def fx_paraphrase(spark, sf_dir) -> DataFrame:
    """(doc_id, sent1, sent2, raw_label)."""
    nb = row_count(spark, sf_dir, "benchmark")
    d = table(spark, sf_dir, "documents")
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("sent2"))
    j = d.join(bench, F.col("doc_id") % F.lit(nb) == F.col("item_id"))
    k = F.col("doc_id") % 6
    return j.select("doc_id", F.col("text").alias("sent1"), "sent2",
                    F.concat(F.lit("("), k.cast("string"), F.lit(", "), (5 - k).cast("string"),
                             F.lit(")")).alias("raw_label"))


# --- predictions and logits ----------------------------------------------------------

def fx_preds(spark, sf_dir) -> DataFrame:
    """(idx, truth, pred, relation) from events."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    nxt = e.select((F.col("event_id") - 1).alias("event_id"), F.col("event_type").alias("next_type"))
    j = e.join(nxt, "event_id", "left")
    pred = F.when((F.col("event_id") % 3 == 0) & F.col("next_type").isNotNull(),
                  F.col("next_type")).otherwise(F.col("event_type"))
    return j.select(F.col("event_id").alias("idx"), F.col("event_type").alias("truth"),
                    pred.alias("pred"),
                    F.when(F.col("event_id") % 5 == 0, "unrelated").otherwise("related")
                    .alias("relation"))


# The class order of the stance logits.
LOGIT_CLASSES = ("support", "deny", "comment")


def fx_logits(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(test, model_a, model_b): test (idx, source, target, stance); models
    (idx, pred, logits array<double>)."""
    nb = row_count(spark, sf_dir, "benchmark")
    e = table(spark, sf_dir, "embeddings")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("text").alias("source"))
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("target"))
    classes = F.array(*[F.lit(c) for c in LOGIT_CLASSES])
    nd = row_count(spark, sf_dir, "documents")
    test = (e.join(docs, e["vec_id"] % F.lit(nd) == docs["doc_id"])
            .join(bench, e["vec_id"] % F.lit(nb) == bench["item_id"])
            .select(F.col("vec_id").alias("idx"), "source", "target",
                    F.element_at(classes, (F.col("label") % 3 + 1).cast("int")).alias("stance")))

    def model(lo):
        logits = F.slice(F.col("embedding"), lo, 3).cast("array<double>")
        return e.select(F.col("vec_id").alias("idx"), logits.alias("logits")).select(
            "idx", F.element_at(classes, (F.array_position(F.col("logits"), F.array_max("logits")))
                                .cast("int")).alias("pred"), "logits")
    return test, model(1), model(4)
