"""Reply-thread jobs (J03, J04, J05, J11) over edge tables.

Tables (``thread`` scopes every id):
- posts     (thread, post, text): posts that have text (the folder maps);
- is_source marks source posts (the ``source-tweet`` folder);
- edges     (thread, parent, node): reply structure (``sources.scan_reply_edges``);
- labels    (thread, post, label): raw label map;
- headlines (thread, headline): bag of headlines per thread.

The reference walks each tree recursively in Python. Here J05 has a closed
form: a reply's label toward the headline is the parity of ``deny`` labels on
the path source -> reply, defined iff the source and every reply on the path
have text and a support/deny label (and the thread has a headline). The path
product is computed by pointer doubling: each round joins every unresolved
node's state with its current ancestor's state, so a depth-d tree resolves in
ceil(log2 d) + 1 shuffle joins regardless of how deep or skewed it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.labels import RUMOUR_STANCE
from quarry.session import checkpoint_dir

PROPAGATING = ["support", "deny"]


def _labelled(labels: DataFrame) -> DataFrame:
    return labels.select("thread", "post", "label")


def join_thread_pairs(edges: DataFrame, posts: DataFrame, labels: DataFrame) -> DataFrame:
    """For each reply edge whose two posts have text and whose reply has
    a supported label: (reply text, parent text, reply label)."""
    p = posts.select("thread", "post", "text")
    parent_text = p.select("thread", F.col("post").alias("parent"), F.col("text").alias("target"))
    node_text = p.select("thread", F.col("post").alias("node"), F.col("text").alias("source"))
    lab = _labelled(labels).filter(F.col("label").isin(list(RUMOUR_STANCE))).select(
        "thread", F.col("post").alias("node"), "label")
    j = (edges.select("thread", "parent", "node")
         .join(parent_text, ["thread", "parent"])
         .join(node_text, ["thread", "node"])
         .join(lab, ["thread", "node"]))
    return j.select("thread", "parent", "node", "source", "target", "label")


def seeded_sources(posts: DataFrame, labels: DataFrame, headlines: DataFrame) -> DataFrame:
    """Labelled source posts with a supported label in threads with a headline:
    (thread, post, text, label). These seed J04 and J05."""
    src = posts.filter(F.col("is_source")).select("thread", "post", "text")
    lab = _labelled(labels).filter(F.col("label").isin(list(RUMOUR_STANCE)))
    has_headline = headlines.select("thread").distinct()
    return src.join(lab, ["thread", "post"]).join(has_headline, "thread", "left_semi")


def join_source_headlines(posts: DataFrame, labels: DataFrame, headlines: DataFrame) -> DataFrame:
    """Each labelled source post x every headline of its thread:
    (source text, headline, label)."""
    src = seeded_sources(posts, labels, headlines)
    j = src.join(headlines.select("thread", "headline"), "thread")
    return j.select("thread", "post", F.col("text").alias("source"),
                    F.col("headline").alias("target"), "label")


def path_parity(edges: DataFrame, node_ok: DataFrame) -> DataFrame:
    """Pointer doubling over a forest.

    ``node_ok``: (thread, node, ok boolean, bit int) for every node (roots
    included). Returns (thread, node, ok, bit, cycle) where ``ok`` is the AND and
    ``bit`` the XOR over the whole path root -> node. Each round doubles the
    distance covered, so a path among n nodes is done within log2(n) + 1
    rounds; what still moves then leads into a cycle and comes back with
    ok = false and cycle = true."""
    spark = edges.sparkSession
    checkpoint_dir(spark)
    parent = edges.select("thread", "node", F.col("parent").alias("anc"))
    state = (node_ok.join(parent, ["thread", "node"], "left")
             .select("thread", "node", "anc", F.col("ok").cast("boolean").alias("ok"),
                     F.col("bit").cast("int").alias("bit")))
    # resolved nodes never change again: each is written once, and a round
    # writes only the rows still moving (total writes ~2N instead of N log d)
    state = state.checkpoint(eager=True)
    resolved = [state.filter(F.col("anc").isNull())]
    active = state.filter(F.col("anc").isNotNull())
    moving = active.count()
    for _ in range(moving.bit_length() + 1):
        if active.isEmpty():
            break
        full = active
        for part in resolved:
            full = full.unionByName(part)
        look = full.select("thread", F.col("node").alias("anc"), F.col("anc").alias("anc2"),
                           F.col("ok").alias("ok2"), F.col("bit").alias("bit2"))
        # an ancestor missing from the table (no text/unknown node) fails the path
        stepped = active.join(look, ["thread", "anc"], "left").select(
            "thread", "node", F.col("anc2").alias("anc"),
            (F.col("ok") & F.coalesce(F.col("ok2"), F.lit(False))).alias("ok"),
            F.col("bit").bitwiseXOR(F.coalesce(F.col("bit2"), F.lit(0))).alias("bit"))
        # one write per round of the rows that moved; both parts read it back
        stepped = stepped.checkpoint(eager=True)
        resolved.append(stepped.filter(F.col("anc").isNull()))
        active = stepped.filter(F.col("anc").isNotNull())
    out = active.withColumn("ok", F.lit(False)).withColumn("cycle", F.lit(True))
    for part in resolved:
        out = out.unionByName(part.withColumn("cycle", F.lit(False)))
    return out.select("thread", "node", "ok", "bit", "cycle")


def propagate_headline_labels(edges: DataFrame, posts: DataFrame, labels: DataFrame,
                              headlines: DataFrame) -> DataFrame:
    """One row per (reply, headline) with the propagated label
    (support when the path holds an even number of deny labels, else deny)."""
    lab = _labelled(labels)
    text_nodes = posts.select("thread", F.col("post").alias("node"), "is_source")
    seeds = seeded_sources(posts, labels, headlines).select(
        "thread", F.col("post").alias("node"), F.lit(True).alias("_q_seed"))
    node_lab = lab.select("thread", F.col("post").alias("node"), "label")
    all_nodes = (edges.select("thread", "node")
                 .unionByName(edges.select("thread", F.col("parent").alias("node"))).distinct())
    info = (all_nodes.join(text_nodes, ["thread", "node"], "left")
            .join(node_lab, ["thread", "node"], "left")
            .join(seeds, ["thread", "node"], "left"))
    is_child = edges.select("thread", "node").distinct().withColumn("_q_child", F.lit(True))
    info = info.join(is_child, ["thread", "node"], "left")
    good_label = F.coalesce(F.col("label").isin(PROPAGATING), F.lit(False))
    has_text = F.col("is_source").isNotNull()
    # a root must be a seeded source; a reply needs text and a support/deny label
    ok = F.when(F.col("_q_child").isNull(), F.coalesce(F.col("_q_seed"), F.lit(False)) & good_label
                ).otherwise(has_text & good_label)
    node_ok = info.select("thread", "node", ok.alias("ok"),
                          F.when(F.col("label") == "deny", 1).otherwise(0).alias("bit"))
    resolved = path_parity(edges, node_ok)
    replies = resolved.filter(F.col("ok")).join(is_child, ["thread", "node"])
    texts = posts.select("thread", F.col("post").alias("node"), F.col("text").alias("source"))
    out = replies.join(texts, ["thread", "node"]).join(headlines.select("thread", "headline"),
                                                       "thread")
    return out.select("thread", "node", "source", F.col("headline").alias("target"),
                      F.when(F.col("bit") == 0, F.lit("support")).otherwise(F.lit("deny"))
                      .alias("label"))


def unmatched_report(edges: DataFrame, posts: DataFrame, labels: DataFrame,
                     manifest: DataFrame | None = None,
                     headline_table: DataFrame | None = None, cycles: bool = False) -> DataFrame:
    """What the reference prints and skips, as rows (thread, item, reason):
    edge posts without text, replies without a label, source posts without a
    label, and manifest URLs without a headline. One row per occurrence. With
    ``cycles`` also the nodes whose parents lead into a cycle (no tree)."""
    p = posts.select("thread", "post").withColumn("_q_t", F.lit(True))
    lab = _labelled(labels).select("thread", "post").withColumn("_q_l", F.lit(True))
    e = (edges.select("thread", "parent", "node")
         .join(p.withColumnRenamed("post", "parent").withColumnRenamed("_q_t", "_q_pt"),
               ["thread", "parent"], "left")
         .join(p.withColumnRenamed("post", "node").withColumnRenamed("_q_t", "_q_nt"),
               ["thread", "node"], "left")
         .join(lab.withColumnRenamed("post", "node"), ["thread", "node"], "left"))
    reason = (F.when(F.col("_q_pt").isNull(), F.lit("no_text"))
              .when(F.col("_q_nt").isNull(), F.lit("no_text"))
              .when(F.col("_q_l").isNull(), F.lit("no_label")))
    item = F.when(F.col("_q_pt").isNull(), F.col("parent")).otherwise(F.col("node"))
    out = e.select("thread", item.cast("string").alias("item"), reason.alias("reason")).filter(
        F.col("reason").isNotNull())
    src = posts.filter(F.col("is_source")).select("thread", "post")
    src_missing = src.join(lab, ["thread", "post"], "left_anti").select(
        "thread", F.col("post").cast("string").alias("item"), F.lit("no_label").alias("reason"))
    out = out.unionByName(src_missing)
    if cycles:
        nodes = edges.select("thread", "node").unionByName(
            edges.select("thread", F.col("parent").alias("node"))).distinct()
        found = path_parity(edges, nodes.withColumn("ok", F.lit(True)).withColumn("bit", F.lit(0)))
        out = out.unionByName(found.filter("cycle").select(
            "thread", F.col("node").cast("string").alias("item"), F.lit("cycle").alias("reason")))
    if manifest is not None and headline_table is not None:
        known = headline_table.select("url_id").distinct()
        miss = manifest.join(known, "url_id", "left_anti").select(
            "thread", F.col("url_id").cast("string").alias("item"),
            F.lit("no_headline").alias("reason"))
        out = out.unionByName(miss)
    return out
