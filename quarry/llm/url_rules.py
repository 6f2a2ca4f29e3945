"""URL filters (operator 1): fixed host/path rules, then mined token rules.

Fixed rules name a host (with all its subdomains) and a path beginning; the
longest that fits decides. Other urls are judged by association rules:
combinations of url tokens that go with a blocked label (low quality or toxic)
in the labelled pages. A rule stays if its confidence and support suffice and
no shorter rule within it is as sure. Spark's FP-growth mines the combinations
frequent among blocked pages; how many labelled pages hold each is counted
through an inverted index, which gives the confidences. A token that all pages
have, or only blocked ones, can add nothing to a longer rule and is left out of
the baskets; of tokens that stand in exactly the same pages one is mined for all
(they would multiply each other), and rules are spelled out for each of them
afterwards. Rules are matched through an inverted index: each rule is posted
under its rarest token, a page looks its tokens up and checks the rest of the
rules found there. Built-in DataFrame functions and Spark's own miner only.

Bound of the model (a parameter, all data is judged): mining takes about
``max_rows`` labelled pages chosen by a hash of page_id. Tokens, tokens per page
and rules are not limited; a token below the least support is in no rule. The
index is broadcast up to ``BROADCAST_BYTES``, joined by a shuffle beyond.

Defined cases: a null url or one without ``://`` has an empty host and path,
no rule and no tokens, and is allowed; an empty path matches no rule that has a
path; repeated rows are judged each and alike; without labels there are no mined
rules; an empty table gives an empty result; a null page_id stays null.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import saved

#: (verdict, host, path)
FIXED_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
               ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MIN_SUPPORT, MIN_ROWS, MIN_CONFIDENCE = 0.002, 5, 0.6
MAX_ROWS = 200_000
BROADCAST_BYTES = 32 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url):
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url):
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def url_tokens(url):
    """Distinct lower-case runs of letters, digits and hyphens that are not all digits."""
    parts = F.split(F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER), "[^a-z0-9-]+")
    return F.array_distinct(F.filter(parts, lambda t: (t != "") & ~t.rlike("^[0-9-]*$")))


def fixed_rule(host, path, rules=FIXED_RULES):
    """(rule, verdict) columns of the longest fixed rule that fits; equal
    lengths: the longer host, then block."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    order = sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"))
    for v, h, p in order:  # each longer rule goes in front of the chain
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               max_rows: int = MAX_ROWS) -> DataFrame | None:
    """Rules (tokens, confidence, support, anchor) from rows (page_id, url,
    blocked); None if nothing is labelled. ``anchor`` is the rule's rarest token."""
    total = labelled.count()
    if total == 0:
        return None
    share = int(min(1.0, max_rows / total) * (1 << 31))
    rows = saved(labelled.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 31)) < share)
                 .select(F.monotonically_increasing_id().alias("row"), F.col("blocked").cast("long").alias("b"),
                         url_tokens(F.col("url")).alias("tokens")))
    mined = rows.count()
    need = math.ceil(max(min_support, MIN_ROWS / total) * mined - 1e-9)
    n, b = F.col("n"), F.col("b")
    confidence = F.round(b / n, 9)
    words = rows.select("row", "b", F.explode("tokens").alias("token"))
    # a token's pages in two hashes: equal ones stand for equal sets of pages
    pages = (F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("h2"))
    tokens = saved(words.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b"), *pages).where(b >= need))
    singles = tokens.select(F.array("token").alias("tokens"), "n", "b")
    open_tokens = tokens.where((b < n) & (n < mined))
    alike = saved(open_tokens.groupBy("n", "b", "h1", "h2").agg(F.min("token").alias("token"), F.collect_list("token").alias("members")))
    kept = words.join(alike.select("token"), "token")
    baskets = saved(kept.groupBy("row", "b").agg(F.sort_array(F.collect_list("token")).alias("items")).where(F.size("items") > 1))
    longer = _frequent_sets(baskets, need)
    found = singles
    if longer is not None:
        found = singles.unionByName(_counted(longer, baskets, alike).select("tokens", "n", "b"))
    found = saved(found.where(b / n >= min_confidence).select("tokens", "n", "b", confidence.alias("confidence")))
    rules = _spelled_out(_without_covered(found, tokens), alike)
    return _posted(saved(rules), tokens).select("tokens", "confidence", F.round(b / F.lit(mined), 9).alias("support"), F.col("token").alias("anchor"))


def _spelled_out(rules: DataFrame, alike: DataFrame) -> DataFrame:
    """Rules of several tokens once for each choice among tokens of the same pages."""
    single, several = rules.where(F.size("tokens") == 1), rules.where(F.size("tokens") > 1)
    members = (several.select("tokens", F.explode("tokens").alias("token")).join(alike.select("token", "members"), "token")
               .groupBy("tokens").agg(F.collect_list("members").alias("choices")))
    start = F.array(F.array().cast("array<string>"))
    combined = F.aggregate("choices", start, lambda made, more: F.flatten(F.transform(
        made, lambda m: F.transform(more, lambda t: F.concat(m, F.array(t))))))
    spelled = several.join(members, "tokens").select(F.explode(combined).alias("made"), "n", "b", "confidence")
    return single.unionByName(spelled.select(F.sort_array("made").alias("tokens"), "n", "b", "confidence"))


def _frequent_sets(baskets: DataFrame, need: int) -> DataFrame | None:
    """(tokens, b): combinations of two and more tokens in at least ``need`` blocked baskets."""
    blocked = baskets.where("b = 1").select("items")
    size = blocked.count()
    if size < need or not size:
        return None
    model = FPGrowth(itemsCol="items", minSupport=max(need - 0.5, 0.5) / size).fit(blocked)
    return model.freqItemsets.where(F.size("items") > 1).select(F.sort_array("items").alias("tokens"), F.col("freq").alias("b"))


def _counted(sets: DataFrame, baskets: DataFrame, tokens: DataFrame) -> DataFrame:
    """``sets`` with n, the number of baskets that hold all tokens: each set is
    posted under its rarest token, a basket looks its tokens up."""
    posted = _posted(saved(sets), tokens)
    looked = baskets.select("items", F.explode("items").alias("token")).join(posted, "token")
    held = looked.where(F.size(F.array_except("tokens", "items")) == 0)
    return held.groupBy("tokens", "b").agg(F.count(F.lit(1)).alias("n"))


def _posted(sets: DataFrame, tokens: DataFrame) -> DataFrame:
    """``sets`` with token: the rarest of its tokens."""
    one = sets.select("tokens", F.explode("tokens").alias("token")).join(tokens.select("token", F.col("n").alias("often")), "token")
    rarest = one.groupBy("tokens").agg(F.min(F.struct("often", "token"))["token"].alias("token"))
    return sets.join(rarest, "tokens")


def _without_covered(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """The rules of which no shorter part is as sure: a rule looks up those posted under its tokens."""
    short = _posted(rules, tokens).select("token", F.col("tokens").alias("part"), F.col("confidence").alias("as_sure"))
    covered = (rules.select("tokens", "confidence", F.explode("tokens").alias("token")).join(short, "token")
               .where((F.size("part") < F.size("tokens")) & (F.col("as_sure") >= F.col("confidence"))
                      & (F.size(F.array_except("part", "tokens")) == 0)))
    return rules.join(covered.select("tokens").distinct(), "tokens", "left_anti")


def judge(pages: DataFrame, rules: DataFrame | None, fixed=FIXED_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and mined_rule (the surest that fits)."""
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    seen = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url",
                        host.alias("host"), path.alias("path"))
    if rules is None:
        matched = seen.withColumn("mined_rule", F.lit(None).cast("string"))
    else:
        index = rules.select(F.col("anchor").alias("token"), F.struct(
            "confidence", "support", F.concat_ws(" ", "tokens").alias("name")).alias("hit"), F.col("tokens").alias("needs"))
        width = F.octet_length("token") + F.octet_length("hit.name") * 2 + 8 * F.size("needs") + 64
        if (index.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES:
            index = F.broadcast(index)
        has = url_tokens(F.when(F.col("host") != "", F.col("url")))
        tokens = seen.withColumn("has", has)
        looked = (tokens.select("*", F.explode_outer("has").alias("token"))
                  .join(index, "token", "left")
                  .withColumn("hit", F.when(F.size(F.array_except("needs", "has")) == 0, F.col("hit"))))
        matched = looked.groupBy("row").agg(*(F.first(c).alias(c) for c in ("page_id", "host", "path")),
                                            F.max("hit")["name"].alias("mined_rule"))
    name, verdict = fixed_rule(F.col("host"), F.col("path"), fixed)
    by_method = F.when(F.col("mined_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return matched.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"), "mined_rule")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Pages with a label: blocked is low quality or toxic; several labels of a
    page are joined by or, and null marks say nothing."""
    marks = labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    marks = marks.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).alias("blocked"))
    return pages.select("page_id", "url").where(F.col("url").isNotNull()).join(marks, "page_id")


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(pages, mine_rules(labelled_pages(pages, labels))).select("page_id", "host", "path", "rule", "verdict")
