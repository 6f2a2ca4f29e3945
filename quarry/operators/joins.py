"""Joins between corpus tables.

No join here forces a broadcast: both sides can grow with the corpus, so
Catalyst and AQE pick broadcast / shuffled-hash / sort-merge from runtime
sizes (``spark.sql.autoBroadcastJoinThreshold`` is the size check), and AQE
splits skewed partitions of a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.math import softmax
from quarry.operators.indexing import keep_one_per_key


def join_stance_bodies(stances: DataFrame, bodies: DataFrame, body_key: str = "body_id",
                       body_col: str = "body", headline_col: str = "headline",
                       label_col: str = "stance", body_order: str = "position",
                       strict: bool = True) -> DataFrame:
    """Stances N:1 bodies on the body id -> (source=body, target=headline, label).

    Of equal body ids the last one (by ``body_order``, which bodies must have) wins. ``strict``
    keeps the reference's hard error on a missing body (D20) without an extra
    action: the join is a left join whose projection raises when no body
    matched, so the check rides along the one pass."""
    b = keep_one_per_key(bodies.select(body_key, body_col, body_order), [body_key], body_order,
                         keep="last")
    b = b.select(F.col(body_key), F.col(body_col).alias("_q_body"), F.lit(True).alias("_q_hit"))
    if strict:
        joined = stances.join(b, body_key, "left")
        source = F.when(F.col("_q_hit").isNull(), F.raise_error(
            F.concat(F.lit("missing body for id "), F.col(body_key).cast("string")))
        ).otherwise(F.col("_q_body"))
    else:
        joined = stances.join(b, body_key, "inner")
        source = F.col("_q_body")
    keep = [c for c in stances.columns if c not in (headline_col, label_col)]
    return joined.select(*keep, source.alias("source"), F.col(headline_col).alias("target"),
                         F.col(label_col).alias("label"))


#: What tells one article from another (the same id occurs on both sides of a dataset).
ARTICLE_KEYS = ("dataset", "news_label", "news_id")


def join_articles_posts(articles: DataFrame, posts: DataFrame, keys=None,
                        title_col: str = "title", description_col: str = "description",
                        post_col: str = "post", default_stance: str = "comment") -> DataFrame:
    """Each post gives (post, title) if the title is non-empty and
    (post, description) if the description is non-empty; label ``comment``.
    Joined on those of ``ARTICLE_KEYS`` that both sides have."""
    keys = list(keys) if keys else [c for c in ARTICLE_KEYS if c in articles.columns and c in posts.columns]
    a = articles.select(*keys, F.array(
        F.struct(F.lit(0).alias("target_kind"), F.col(title_col).alias("target")),
        F.struct(F.lit(1).alias("target_kind"), F.col(description_col).alias("target"))
    ).alias("_q_targets"))
    joined = posts.join(a, keys)
    exploded = joined.withColumn("_q_t", F.explode("_q_targets")).drop("_q_targets")
    out = exploded.filter(F.length(F.col("_q_t.target")) > 0)
    return out.select(*[c for c in posts.columns],
                      F.col("_q_t.target_kind").alias("target_kind"),
                      F.col(post_col).alias("source"), F.col("_q_t.target").alias("target"),
                      F.lit(default_stance).alias("label"))


def zip_predictions_truth(preds: DataFrame, truth: DataFrame, idx: str = "idx",
                          pred_col: str = "pred", truth_col: str = "truth",
                          strict: bool = True) -> DataFrame:
    """Positional join of predictions and truth on the row index.

    ``strict`` fails the job when an index is on one side only (the sizes
    assertion), using a full outer join so no separate count pass runs."""
    p = preds.select(F.col(idx), F.col(pred_col).alias("pred"))
    t = truth.select(F.col(idx), F.col(truth_col).alias("truth"))
    if not strict:
        return p.join(t, idx)
    joined = p.withColumn("_q_p", F.lit(True)).join(t.withColumn("_q_t", F.lit(True)), idx, "full")
    ok = F.col("_q_p").isNotNull() & F.col("_q_t").isNotNull()
    guard = F.when(ok, F.lit(True)).otherwise(F.raise_error(
        F.concat(F.lit("predictions and truth differ in size at index "), F.col(idx).cast("string"))))
    return joined.filter(guard).select(idx, "pred", "truth")


def combine_stance_relation(stance: DataFrame, relation: DataFrame, idx: str = "idx",
                            stance_col: str = "stance", relation_col: str = "relation",
                            out: str = "label") -> DataFrame:
    """Final label = ``unrelated`` where the relation says so, else the stance."""
    z = zip_predictions_truth(stance, relation, idx, stance_col, relation_col)
    return z.select(F.col(idx), F.when(F.col("truth") == "unrelated", F.lit("unrelated"))
                    .otherwise(F.col("pred")).alias(out))


def override_merge(left: DataFrame, right: DataFrame, keys, value: str = "value") -> DataFrame:
    """Key-value union where the right side wins (``{**left, **right}``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    l = left.select(*keys, F.col(value).alias("_q_l"))
    r = right.select(*keys, F.col(value).alias("_q_r"), F.lit(True).alias("_q_in_r"))
    j = l.join(r, keys, "full")
    return j.select(*keys, F.when(F.col("_q_in_r"), F.col("_q_r")).otherwise(F.col("_q_l"))
                    .alias(value))


def experiment_summary(test: DataFrame, model_a: DataFrame, model_b: DataFrame,
                       idx: str = "idx", names=("fnc", "re17"),
                       classes=("support", "deny", "comment")) -> DataFrame:
    """Test rows + two models' predictions and softmaxed logits -> 12 columns.

    ``model_*`` hold (idx, pred, logits array<double>); all three must hold
    the same indices (strict full-outer guard, as J06)."""
    out = test.select(idx, "source", "target", "stance")
    for name, m in zip(names, [model_a, model_b]):
        probs = softmax(F.col("logits"))
        cols = [F.col(idx), F.col("pred").alias(f"{name}_predictions")]
        cols += [F.element_at(probs, i + 1).alias(f"{name}_{c}")
                 for i, c in enumerate(classes)]
        side = m.select(*cols).withColumn(f"_q_{name}", F.lit(True))
        out = out.withColumn(f"_q_l_{name}", F.lit(True)).join(side, idx, "full")
        ok = F.col(f"_q_l_{name}").isNotNull() & F.col(f"_q_{name}").isNotNull()
        out = out.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(
            F.lit(f"{name} predictions and test data differ in size")))).drop(
            f"_q_l_{name}", f"_q_{name}")
    return out


#: Size up to which the listed keys are sent to the pairs (letters plus a fixed part per key).
BROADCAST_KEYS_BYTES = 64 << 20


def pair_semi_anti_split(pairs: DataFrame, dev_ids: DataFrame, keys=("id1", "id2"),
                         split_out: str = "split") -> DataFrame:
    """``dev`` for pairs listed in ``dev_ids``, ``train`` for the rest.

    One left join against the distinct dev keys with a marker column replaces
    a semi-join plus an anti-join. The keys go to the pairs, whose texts then
    stay where they are, if their measured size allows; more keys are met in a shuffle of the pairs."""
    keys = list(keys)
    d = dev_ids.select(*keys).distinct()
    size = d.agg(F.sum(sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(100)))).first()[0] or 0
    d = d.withColumn("_q_dev", F.lit(True))
    j = pairs.join(F.broadcast(d) if size <= BROADCAST_KEYS_BYTES else d, keys, "left")
    return j.withColumn(split_out, F.when(F.col("_q_dev"), F.lit("dev")).otherwise(F.lit("train"))
                        ).drop("_q_dev")
