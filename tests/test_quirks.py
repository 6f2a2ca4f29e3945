"""One test per quirk decision that is not covered elsewhere."""

import pytest
from pyspark.sql import functions as F

from quarry import sinks
from quarry.functions.text import simple_clean
from quarry.operators import cleaning, filters, joins, labels, threads


def test_d01_batch_window_none_keeps_all_and_bounds_finish_article(spark):
    posts = spark.createDataFrame([("fake", a, p) for a in range(3) for p in range(4)],
                                  "news_label string, news_id long, post_id long")
    assert filters.batch_window(posts, "news_id", ["news_id", "post_id"], None, None).count() == 12
    got = filters.batch_window(posts, "news_id", ["news_id", "post_id"], 0, 5, "news_label")
    # positions 1..7 of articles started at <= 5: article 0 (start 0) and 1 (start 4)
    assert sorted((r["news_id"], r["post_id"]) for r in got.collect()) == \
        [(0, 1), (0, 2), (0, 3), (1, 0), (1, 1), (1, 2), (1, 3)]


def test_d08_via_cuts_inside_words(spark):
    df = spark.createDataFrame([("we deviate from it",)], "t string")
    assert df.select(cleaning.clean_steps("t")).first()[0] == "we de"


def test_d09_null_text(spark):
    df = spark.createDataFrame([(None,)], "t string")
    row = df.select(simple_clean("t"), simple_clean("t", null_as="nan")).first()
    assert tuple(row) == ("", "nan")


def test_d12_report_filter_always_applies(spark):
    df = spark.createDataFrame([("comment", None, None), (None, None, None), ("support", "a", "b")],
                               "stance string, source string, target string")
    got = filters.drop_report_rows(df).collect()
    assert [r["stance"] for r in got] == ["support"]


def test_d18_comment_source_seeds_nothing(spark):
    P = spark.createDataFrame([(0, 0, "src", True), (0, 1, "r1", False)],
                              "thread long, post long, text string, is_source boolean")
    E = spark.createDataFrame([(0, 0, 1)], "thread long, parent long, node long")
    L = spark.createDataFrame([(0, 0, "comment"), (0, 1, "support")], "thread long, post long, label string")
    H = spark.createDataFrame([(0, "h")], "thread long, headline string")
    assert threads.propagate_headline_labels(E, P, L, H).count() == 0
    assert threads.join_source_headlines(P, L, H).count() == 1      # source x headline row still exists
    assert threads.join_thread_pairs(E, P, L).count() == 1          # D19: reply->parent row kept


def test_d20_missing_body_fails_unknown_stance_drops(spark):
    st = spark.createDataFrame([("h", 1, "agree", 0), ("h", 2, "bogus", 1)],
                               "headline string, body_id long, stance string, ord long")
    bodies = spark.createDataFrame([(1, "b", 0)], "body_id long, body string, position long")
    mapped = labels.map_stance_article(st)
    assert joins.join_stance_bodies(mapped, bodies).count() == 1
    st2 = spark.createDataFrame([("h", 3, "agree", 0)], "headline string, body_id long, stance string, ord long")
    with pytest.raises(Exception, match="missing body"):
        joins.join_stance_bodies(labels.map_stance_article(st2), bodies).collect()


def test_d20_last_duplicate_body_wins(spark):
    st = spark.createDataFrame([("h", 1, "agree")], "headline string, body_id long, stance string")
    bodies = spark.createDataFrame([(1, "old", 0), (1, "new", 1)], "body_id long, body string, ord long")
    got = joins.join_stance_bodies(labels.map_stance_article(st), bodies, body_order="ord").first()
    assert got["source"] == "new"


def test_d22_unsupported_sentiment_fails(spark):
    df = spark.createDataFrame([("x", "positive")], "source string, sentiment string")
    with pytest.raises(Exception, match="Unrecognized label"):
        sinks.sst_layout(df).collect()


def test_d04_forum_without_headlines_keeps_reply_pairs(spark):
    from quarry.plans.pipelines import pipeline_rumour_threads
    P = spark.createDataFrame([(0, 0, "src", True), (0, 1, "r1", False)],
                              "thread long, post long, text string, is_source boolean")
    E = spark.createDataFrame([(0, 0, 1)], "thread long, parent long, node long")
    L = spark.createDataFrame([(0, 0, "support"), (0, 1, "deny")], "thread long, post long, label string")
    H = spark.createDataFrame([], "thread long, headline string")
    rows = pipeline_rumour_threads(E, P, L, H, k=2).collect()
    assert [(r["source"], r["target"], r["stance"]) for r in rows] == [("r1", "src", "deny")]


def test_batch_window_against_plain_numbering(spark):
    import random
    from quarry.operators import filters
    rng = random.Random(5)
    rows = [(rng.choice(["fake", "real"]), rng.randrange(12), i, f"text {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "news_label string, news_id int, post_id int, post string").repartition(5)
    for lo, hi in ((0, 5), (3, 40), (None, 17), (20, None), (500, 900), (-1, -1), (-1, 9)):
        for order in (["news_id", "post_id"], ["post_id"]):
            want = []
            for side in ("fake", "real"):
                mine = sorted((r for r in rows if r[0] == side), key=lambda r: tuple(r[{"news_id": 1, "post_id": 2}[c]] for c in order))
                start = {}
                for pos, r in enumerate(mine):
                    start.setdefault(r[1], pos)
                want += [r for pos, r in enumerate(mine) if (lo is None or pos > lo) and (hi is None or start[r[1]] <= hi) or (lo is None and hi is None)]
            got = filters.batch_window(df, "news_id", order, lo, hi, "news_label")
            assert sorted(tuple(r) for r in got.collect()) == sorted(want), (lo, hi, order)


def test_batch_window_shuffles_no_row_by_its_part(spark):
    """A part (label) holds half of all texts: only its bounds travel."""
    posts = spark.createDataFrame([("fake" if n % 2 else "real", n, p, "text") for n in range(6) for p in range(3)],
                                  "news_label string, news_id long, post_id long, post string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as where the tables are large
    try:
        got = filters.batch_window(posts, "news_id", ["news_id", "post_id"], 0, 4, "news_label")
        plan = got._jdf.queryExecution().sparkPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert joins and all("BroadcastHashJoin" in line for line in joins)
        assert got.count() == 2 * 5
    finally:
        spark.conf.set(key, old)


def test_batch_window_numbers_the_counted_rows_only(spark):
    posts = spark.createDataFrame([("fake", n, p) for n in range(5) for p in range(3)], "news_label string, news_id long, post_id long")
    counted = posts.filter("news_id % 2 = 0")  # posts 0 to 2 are of article 0, 3 to 5 of article 2, 6 to 8 of article 4
    got = filters.batch_window(posts, "news_id", ["news_id", "post_id"], 1, 3, "news_label", counted)
    assert sorted((r["news_id"], r["post_id"]) for r in got.filter("news_id % 2 = 0").collect()) == [(0, 2), (2, 0), (2, 1), (2, 2)]
