"""J03/J04/J05 against a direct recursive walk on random reply trees."""

import random

from pyspark.sql import functions as F

from quarry.operators import threads

LABELS = ["support", "deny", "comment", "query", None]


def make_forest(seed=7, n_threads=25):
    rnd = random.Random(seed)
    posts, edges, labels, heads = [], [], [], []
    for t in range(n_threads):
        size = rnd.randint(1, 40)
        for node in range(size):
            if rnd.random() > 0.1:
                posts.append((t, node, f"text {t}-{node}", node == 0))
            lab = rnd.choice(LABELS)
            if lab:
                labels.append((t, node, lab))
            if node > 0:
                edges.append((t, rnd.randrange(node), node))
        for h in range(rnd.choice([0, 1, 2])):
            heads.append((t, f"headline {t}/{h}"))
    return posts, edges, labels, heads


def walk(posts, edges, labels, heads):
    """Pre-order walk with the loader's rules, as plain Python."""
    text = {(t, p): x for t, p, x, _ in posts}
    lab = {(t, p): l for t, p, l in labels}
    kids = {}
    for t, a, b in edges:
        kids.setdefault((t, a), []).append(b)
    hl = {}
    for t, h in heads:
        hl.setdefault(t, []).append(h)
    j03, j04, j05 = set(), set(), set()
    ok = ("support", "deny", "comment")
    threads_ = sorted({t for t, _, _ in edges} | {t for t, _, _, _ in posts})
    for t in threads_:
        prop = {}
        src = (t, 0)
        if src in text and src in lab and lab[src] in ok:
            for h in hl.get(t, []):
                j04.add((t, 0, text[src], h, lab[src]))
                prop[0] = lab[src]
        stack = [0]
        while stack:
            node = stack.pop()
            for child in kids.get((t, node), []):
                stack.append(child)
                if (t, node) not in text or (t, child) not in text or (t, child) not in lab:
                    continue
                cl = lab[(t, child)]
                if cl not in ok:
                    continue
                j03.add((t, node, child, text[(t, child)], text[(t, node)], cl))
                if node in prop and prop[node] in ("support", "deny") and cl in ("support", "deny"):
                    prop[child] = "support" if prop[node] == cl else "deny"
                    for h in hl.get(t, []):
                        j05.add((t, child, text[(t, child)], h, prop[child]))
    return j03, j04, j05


def test_thread_jobs_match_walk(spark):
    posts, edges, labels, heads = make_forest()
    P = spark.createDataFrame(posts, "thread long, post long, text string, is_source boolean")
    E = spark.createDataFrame(edges, "thread long, parent long, node long")
    L = spark.createDataFrame(labels, "thread long, post long, label string")
    H = spark.createDataFrame(heads, "thread long, headline string")
    e03, e04, e05 = walk(posts, edges, labels, heads)
    assert {tuple(r) for r in threads.join_thread_pairs(E, P, L).collect()} == e03
    assert {tuple(r) for r in threads.join_source_headlines(P, L, H).collect()} == e04
    got05 = [tuple(r) for r in threads.propagate_headline_labels(E, P, L, H).collect()]
    assert len(got05) == len(set(got05)) and set(got05) == e05


def test_path_parity_deep_chain(spark):
    # a 300-deep chain resolves in ~9 doubling rounds
    n = 300
    E = spark.createDataFrame([(0, i - 1, i) for i in range(1, n)], "thread long, parent long, node long")
    ok = spark.createDataFrame([(0, i, True, i % 2) for i in range(n)],
                               "thread long, node long, ok boolean, bit int")
    res = {r["node"]: r["bit"] for r in threads.path_parity(E, ok).collect()}
    for i in range(n):
        assert res[i] == sum(j % 2 for j in range(i + 1)) % 2
