"""The llm operators on small tables: brute force, and the defined odd cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from quarry.llm import (packing, paragraph_sketch, quality_model, registered, rule_cascade, sharding, simhash_dedup,
                        source_mix, suffix_dedup, token_counts, url_rules)
from test_kernels import brute_features, brute_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, __key string, n_words string"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
PASSAGE = "this passage of more than a hundred bytes stands in many documents and must be taken away where it stands again "
TEXTS = [
    (1, "One clean text with many different words that says nothing twice and goes on until it has more than twenty words in all.", "a"),
    (2, None, "b"), (3, "", None), (4, " \n\t ", "b"), (5, "few words", "a"), (6, LONG, "c"), (7, LONG, "c"),
    (8, "start " + PASSAGE + "end of eight", "a"), (9, "other start " + PASSAGE + "end of nine é", None),
    (10, PASSAGE * 3, "b"), (10, PASSAGE * 3, "b"), (11, "é" * 120, "a"), (12, "xé" + "é" * 119, "a"),
    (None, "a text without an id " + PASSAGE, "a"), (None, None, None), (13, "x " * 300, "c"), (14, "a" * 450, "c"),
    (15, "% # $ " * 20 + "word " * 3, "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", s, len(t or ""), "extra", "more", "clash") for d, t, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(rows, *cols):
    return sorted((tuple(r[c] for c in cols) for r in rows), key=repr)


# 1

RULES = sorted([("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
                ("allow", "com", "/fr/"), ("block", "com", "/de/")], key=lambda r: -len(r[1] + r[2]))


def brute_url(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    for verdict, h, p in RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            return host, path, h + p, verdict
    return host, path, None, None


URLS = [None, "", "no-scheme.org/x", "http://Example.ORG/es/1?x#y", "http://example.org/en/1", "https://a.example.org/en/22", "x://org/",
        "x://org", "x://notorg.com/fr/", "x://com/de/#a", "http://b.com/FR/", "http://c.net/a://b.org/", "\n://é.org/\n",
        "http://org?/", "http://", "x://a.org/es/", "x://badexample.org/es/"]


def url_tables(spark):
    urls = URLS + [f"http://spam{i % 3}.net/win/cash{i % 2}/{i}" for i in range(40)] + [f"http://good{i % 4}.net/a/{i}" for i in range(60)]
    pages = spark.createDataFrame([(i, u, "html") for i, u in enumerate(urls)] + [(0, None, None), (None, "http://spam1.net/win/x", None)],
                                  "page_id long, url string, row string")
    marks = [(i, 0 if "spam" in (u or "") else 1, 0) for i, u in enumerate(urls) if i % 2 or i > 30] + [(None, 0, 0), (5, None, None)]
    return pages, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_url_rules(spark):
    pages, labels = url_tables(spark)
    rules = url_rules.mine_rules(url_rules.labelled_pages(pages, labels))
    found = {tuple(r["tokens"]) for r in rules.collect()}
    # brute force: any combination of tokens by support and confidence, without those a sure shorter one covers
    marked = url_rules.labelled_pages(pages, labels).select("page_id", "blocked", url_rules.url_tokens(F.col("url")).alias("t")).collect()
    freq = Counter(t for r in marked for t in r["t"])
    from itertools import combinations
    seen, bad = Counter(), Counter()
    for r in marked:
        items = sorted((t for t in r["t"] if freq[t] >= 5), key=lambda t: (freq[t], t))
        for k in range(1, len(items) + 1):
            for c in combinations(sorted(items), k):
                seen[c] += 1
                bad[c] += r["blocked"]
    least = max(url_rules.MIN_SUPPORT, 5 / len(marked)) * len(marked)
    sure = {c: bad[c] / seen[c] for c in seen if bad[c] >= least - 1e-9 and bad[c] / seen[c] >= url_rules.MIN_CONFIDENCE}
    want = {c for c in sure if not any(set(o) < set(c) and round(sure[o], 9) >= round(sure[c], 9) for o in sure)}
    assert found == want and ("win",) in found
    out = url_rules.judge(pages, rules).collect()
    assert len(out) == pages.count()
    by_id = {r["page_id"]: r for r in out if r["page_id"]}
    for i, u in enumerate(URLS[1:], 1):
        host, path, rule, verdict = brute_url(u)
        assert (by_id[i]["host"], by_id[i]["path"], by_id[i]["rule"]) == (host, path, rule), u
        assert by_id[i]["verdict"] == (verdict or "allow"), u
    assert all(r["verdict"] == "block" and r["rule"] is None for r in out if "spam" in r["host"])
    assert all(r["verdict"] == "allow" for r in out if "good" in r["host"])


def test_url_rules_many_hosts_and_companions(spark, monkeypatch):
    # 40 blocked hosts with twelve tokens around them (2**12 combinations each), one rule at 0.75,
    # and a rule whose tokens are more frequent than ten others of its pages
    around = "/".join(f"com{i}" for i in range(12))
    rows = [(f"http://bad{h}.net/{around}", True) for h in range(40) for _ in range(6)]
    rows += [(f"http://mixed.net/{around}", i % 4 != 0) for i in range(24)]
    for i in range(30):
        rare = "/".join(f"rare{(i + j) % 60}x" for j in range(11))
        rows += [(f"http://often.net/sure/{rare}", True), (f"http://often.net/{rare}", False), ("http://good.net/sure", False)]
    rows += [(f"http://good.net/{around}", False)] * 400
    labelled = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, blocked boolean")
    rules = url_rules.mine_rules(labelled)
    found = {tuple(r["tokens"]): r["confidence"] for r in rules.collect()}
    assert all(found.get((f"bad{h}",)) == 1.0 for h in range(40))
    assert found.get(("mixed",)) == 0.75 and found.get(("often", "sure")) == 1.0
    assert all(len(t) == 1 for t in found if any(w == "mixed" or w.startswith("bad") for w in t))
    anchors = {tuple(r["tokens"]): r["anchor"] for r in rules.collect()}
    assert all(a in t for t, a in anchors.items())
    want = sorted(tuple(r) for r in url_rules.judge(labelled, rules).select("page_id", "verdict").collect())
    monkeypatch.setattr(url_rules, "BROADCAST_BYTES", -1)
    assert sorted(tuple(r) for r in url_rules.judge(labelled, rules).select("page_id", "verdict").collect()) == want
    verdicts = dict(want)
    assert all(verdicts[i] == "block" for i, (u, _) in enumerate(rows) if "bad" in u or "mixed" in u or "often.net/sure" in u)


def test_mined_verdicts_by_a_plain_matcher(spark):
    # tokens of the same pages (left, right) stand for each other in no page that holds only one of them
    rows = [(f"http://x{i % 7}.net/left/right/t{i % 3}/{i}", i % 3 == 0) for i in range(90)]
    rows += [(f"http://x{i % 7}.net/t{i % 3}/u{i % 5}", i % 5 == 1 and i % 3 == 0) for i in range(90)]
    rows += [("http://new.net/left/t0", None), ("http://new.net/right/t0", None), ("http://new.net/right/t1", None), ("http://t0.net/u1", None)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    labelled = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows) if b is not None], "page_id long, url string, blocked boolean")
    mined = url_rules.mine_rules(labelled)
    rules = [(set(r["tokens"]), r["confidence"], r["support"], " ".join(r["tokens"])) for r in mined.collect()]
    assert {"left t0", "right t0"} <= {r[3] for r in rules}
    for r in url_rules.judge(pages, mined).collect():
        url = rows[r["page_id"]][0]
        own = {t for t in re.split("[^a-z0-9-]+", url.lower()) if t and not re.fullmatch("[0-9-]*", t)}
        fit = [(c, s, name) for tokens, c, s, name in rules if tokens <= own]
        assert r["verdict"] == ("block" if fit else "allow"), url
        assert r["mined_rule"] == (max(fit)[2] if fit else None)


def test_url_rules_without_labels_or_pages(spark):
    pages, labels = url_tables(spark)
    assert url_rules.mine_rules(url_rules.labelled_pages(pages, labels.limit(0))) is None
    assert {r["verdict"] for r in url_rules.judge(pages.where("url like '%good%'"), None).collect()} == {"allow"}
    rules = url_rules.mine_rules(url_rules.labelled_pages(pages, labels))
    assert url_rules.judge(pages.limit(0), rules).count() == 0


# 2

def test_quality_classifier_learns_and_scores_all(spark, docs, empty):
    good = [(i, f"alpha beta gamma {i} delta", None) for i in range(0, 120, 2)]
    bad = [(i, f"alpha% beta% zeta {i} delta%", None) for i in range(1, 120, 2)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string, score string")
    labels = table.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("label")).union(
        spark.createDataFrame([(None, 1), (3, None), (4, 7)], "doc_id long, label int"))
    w = quality_model.train(table, labels)
    again = quality_model.train(table.repartition(5), labels)
    assert (w == again).all()
    out = quality_model.score(table, w).collect()
    assert all((r["score"] > 0.5) == (r["doc_id"] % 2 == 0) for r in out) and all(0 <= r["score"] <= 1 for r in out)
    rows = quality_model.score(docs, w).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_model.score(empty, w).count() == 0
    untrained = quality_model.train(table, labels.limit(0))
    assert {r["score"] for r in quality_model.score(docs, untrained).collect()} == {0.5}


def test_quality_query(spark):
    rows = registered.QUERIES["op2_quality_classifier"](spark, SF_SMALL).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == (1 if r["score"] >= 0.3 else 0) for r in rows)


# 3

def brute_pieces(text):
    """Paragraphs by a plain scan over characters."""
    out, at = set(), 0
    while at < len(text):
        if text[at] == "\n":
            at += 1
            continue
        line = text.find("\n", at)
        line = len(text) if line < 0 else line
        tail = len(text) - at < paragraph_sketch.TAIL_CHARS
        least = paragraph_sketch.TAIL_LEAST_CHARS if tail else paragraph_sketch.LEAST_CHARS
        end = min(line, at + paragraph_sketch.PIECE_CHARS)
        for i in range(at + least, at + paragraph_sketch.PIECE_CHARS + 1):
            if i + 1 < line and text[i] in "ds.,;:!?" and text[i + 1] == " ":
                end = i + 2
                break
            if i < line and text[i] in "。！？":
                end = i + 1
                break
        while end < len(text) and text[end] == "\n":
            end += 1
        out.add(text[at:end])
        at = end
    return out


def test_sketches_recover_differences(spark):
    import random
    rng = random.Random(2)
    rows = []
    for i in range(60):
        pool = [f"line {i} {j}" for j in range(rng.choice([0, 1, 3, 20, 150]))]
        a, e, n = (["\n".join(x for x in pool if rng.random() < q) for q in (1, 0.9, 0.3)])
        rows.append((i, a, e, n))
    rows += [(90, "", "", "x"), (91, "same\n\ntext", "same\n\ntext", "")]
    out = paragraph_sketch.compare_versions(spark.createDataFrame(rows, "doc_id long, text string, edited_text string, next_text string")).collect()
    by = {r[0]: r for r in rows}
    for r in out:
        _, a, e, n = by[r["doc_id"]]
        for got, other in ((r["near_edited"], e), (r["near_next"], n)):
            x, y = brute_pieces(a), brute_pieces(other)
            assert got == pytest.approx(len(x & y) / len(x | y) if x | y else 1.0)
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (a == e)


def test_crowded_sketches_fall_back_to_larger(spark):
    """Blocks of the first size must fail sometimes here, and still all be right."""
    rows = [(i, "\n".join(f"a{i} {j}" for j in range(40)), "\n".join(f"b{i} {j}" for j in range(40)), "") for i in range(40)]
    out = paragraph_sketch.compare_versions(spark.createDataFrame(rows, "doc_id long, text string, edited_text string, next_text string"))
    assert {r["near_edited"] for r in out.collect()} == {0.0}


def test_sketches_prepare_their_digests_once(spark):
    """Checks and cell bits are made outside the lambda over the cells, not again for every cell."""
    made = paragraph_sketch.sketch(paragraph_sketch._prepared(F.col("a"), 4), 4)
    for column in (made, paragraph_sketch._block_outcome(F.col("part"))):
        given = re.findall(r"sequence\(0, \d+\), \w+ -> aggregate\(\w+(.)", str(column))
        assert given and set(given) == {","}  # a lambda's argument, not the expression that prepares the digests
    digests = [5, -7, 1 << 40, -(1 << 62)]
    rows = spark.createDataFrame([(digests, digests[1:])], "a array<long>, b array<long>")
    one, other = (paragraph_sketch.sketch(paragraph_sketch._prepared(F.col(c), 4), 4) for c in "ab")
    left = rows.select(paragraph_sketch.subtract(one, other).alias("x")).first()["x"]
    assert sorted((c["n"], c["x"]) for c in left if c["n"]) == [(1, 5)] * 3 and len(left) == 12


def test_long_lines_are_cut_by_their_words(spark):
    """A changed end and an inserted word leave the other paragraphs of one line alike."""
    import random
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    short, line, far = " ".join(words[:30]), " ".join(words), "漢字仮名" * 300
    rows = [(1, short, short[:2 * len(short) // 3] + "x" * (len(short) // 3), ""),
            (2, line, "inserted " + line, ""),
            (3, far, far[:-200] + "字" * 200, "")]
    out = paragraph_sketch.compare_versions(spark.createDataFrame(rows, "doc_id long, text string, edited_text string, next_text string"))
    got = {r["doc_id"]: r["near_edited"] for r in out.collect()}
    for doc, a, b, _ in rows:
        x, y = brute_pieces(a), brute_pieces(b)
        assert got[doc] == pytest.approx(len(x & y) / len(x | y))
    assert got[1] > 0.2 and got[2] > 0.9


def test_sketches_of_a_very_long_text(spark):
    """Ten megabytes in one row: the work follows the number of paragraphs."""
    lines = [f"{i:x} {hashlib.sha512(str(i).encode()).hexdigest()}" for i in range(75_000)]
    text, other = "\n".join(lines), "\n".join(x for i, x in enumerate(lines) if i % 1000)
    row = spark.createDataFrame([(1, text, other, "")], "doc_id long, text string, edited_text string, next_text string")
    r = paragraph_sketch.compare_versions(row).select("near_edited", "near_next").first()
    x, y = brute_pieces(text), brute_pieces(other)
    assert len(text) > 9_000_000 and r["near_next"] == 0.0
    assert r["near_edited"] == pytest.approx(len(x & y) / len(x | y))


def test_next_document_where_an_id_fills_ranges(spark):
    """Half of the rows without an id, a third of the others with the same one."""
    rows = [(None if i % 2 else (7 if i % 3 else i), f"text {i % 170}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]], r[1]), reverse=True)
    want = sorted([(*r, order[(i + 1) % len(order)][1]) for i, r in enumerate(order)], key=repr)
    assert pairs(paragraph_sketch.with_next(docs).collect(), "doc_id", "text", "next_text") == want


def test_next_document(spark, docs, empty):
    got = pairs(paragraph_sketch.with_next(docs).collect(), "doc_id", "text", "next_text")
    def key(r):
        return (r[0] is not None, r[0] or 0)
    hashes = {r["text"]: r["h"] for r in docs.select(F.coalesce("text", F.lit("")).alias("text")).distinct()
              .withColumn("h", F.xxhash64("text")).collect()}
    rows = sorted([(d, t or "") for d, t, _ in TEXTS], key=lambda r: (*key(r), hashes[r[1]], r[1]), reverse=True)
    assert got == sorted([(*r, rows[(i + 1) % len(rows)][1]) for i, r in enumerate(rows)], key=repr)
    assert paragraph_sketch.with_next(empty).count() == 0
    one = docs.where("doc_id = 8")
    assert one.count() == 1 and [r["next_text"] == r["text"] for r in paragraph_sketch.with_next(one).collect()] == [True]


def test_fingerprint_query(spark):
    rows = registered.QUERIES["op3_document_fingerprints"](spark, SF_SMALL).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    for r in rows:
        t, n = texts[r["doc_id"]], texts[after[r["doc_id"]]]
        k = len(t) // 3
        edited = t[:len(t) - k] + n[:k]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        x, y = brute_pieces(t), brute_pieces(edited)
        assert r["near_edited"] == pytest.approx(len(x & y) / len(x | y) if x | y else 1.0)
    assert len(rows) == len(texts)


# 4

def rejected(text):
    f = brute_features(text or "")
    return (f["n_words"] < 20 or 100 * f["n_repeat_words"] > 30 * f["n_words"] or 10 * f["n_symbols"] > 3 * f["n_words"]
            or 2 * f["n_dup_lines"] > f["n_lines"] or not 2 * f["n_words"] <= f["word_chars"] <= 15 * f["n_words"]
            or 10 * f["n_same_words"] > 3 * f["n_words"])


def test_cascade_verdict_does_not_depend_on_order(docs, empty):
    want = sorted([(d, t, not rejected(t)) for d, t, _ in TEXTS], key=repr)
    for rules in (rule_cascade.RULES, rule_cascade.RULES[::-1]):
        out = rule_cascade.cascade(docs, rules, features=("n_words",))
        assert pairs(out.collect(), "doc_id", "text", "kept") == want
        assert {c for c in out.columns} >= {"__key", "lang", "n_words"}
    assert rule_cascade.quality_rules(empty).count() == 0


def test_rules_are_ordered_by_rejection_per_cost(docs):
    estimates = rule_cascade.estimate(docs)
    assert {e["rule"] for e in estimates} == {r.name for r in rule_cascade.RULES} and any(e["selectivity"] > 0 for e in estimates)
    made = [{"rule": r.name, "cost": c, "selectivity": s} for r, c, s in zip(rule_cascade.RULES, (1, 2, 1, 5, 1, 1), (.1, .9, .0, .9, .3, .0))]
    assert [r.name for r in rule_cascade.order_rules(rule_cascade.RULES, made)][:4] == ["repeats_itself", "odd_word_length", "same_lines", "too_short"]


def test_cascade_short_circuits():
    seen = []
    first = rule_cascade.Rule("first", lambda v: v.feature("n_words") < 2)
    second = rule_cascade.Rule("second", lambda v: (seen.append(len(v)), v.feature("n_words") < 0)[1])
    import pyarrow as pa
    from quarry.llm import _bytes
    view = rule_cascade.View(*_bytes.text_bytes(pa.array(["a", "b c", "d", "e f g"])))
    second.rejects(view.take(~first.rejects(view)))
    assert seen == [2]


# 5

def brute_removed(rows, length):
    def order(d, t, p):  # texts that share an id are told apart and ordered by their hash
        h = xxhash.xxh64_intdigest(t, seed=42)
        return d is None, d or 0, h - (1 << 64) if h >= 1 << 63 else h, p
    places = defaultdict(set)
    for d, t in rows:
        for p in range(len(t) - length + 1):
            places[t[p:p + length]].add(order(d, t, p))
    first = {w: min(x) for w, x in places.items()}
    out = []
    for d, t in rows:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if first[t[p:p + length]] < order(d, t, p):
                gone[p:p + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"crowd": 1}, {"frequent_at": 1, "one_in": 1}, {"frequent_at": 3, "one_in": 1, "crowd": 1, "length": 300}])
def test_suffix_dedup_of_texts_that_share_an_id(spark, options):
    # the same passages at the same and at other places of different texts with one id, with none, and with ids of their own
    rows = [(d, f"{PASSAGE * (1 + i % 3)}own words of {i} " + ("" if i % 2 else "more " * (i % 5)) + PASSAGE[: 40 + i] + "x" * (i % 4))
            for i, d in enumerate([7] * 14 + [None] * 14 + [3, 8, 8, 9, 9, 2])]
    rows += rows[3:6] + rows[20:22] + [(7, ""), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = suffix_dedup.drop_repeats(table, **options).collect()
    assert [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
            for r in pairs(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes")] == brute_removed(
                [(d, (t or "").encode()) for d, t in rows], options.get("length", 100))


@pytest.mark.parametrize("options", [{}, {"crowd": 1}, {"frequent_at": 1, "one_in": 1}, {"frequent_at": 3, "one_in": 1, "crowd": 1}])
def test_suffix_dedup(docs, empty, options):
    rows = [(d, (t or "").encode()) for d, t, _ in TEXTS if t != LONG]
    small = docs.where(F.coalesce(F.length("text"), F.lit(0)) < 10_000)
    out = suffix_dedup.drop_repeats(small, **options)
    assert [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
            for r in pairs(out.collect(), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes")] == brute_removed(rows, 100)
    if not options:
        assert suffix_dedup.drop_repeats(empty).count() == 0


def test_suffix_dedup_of_long_copies(docs):
    out = {r["doc_id"]: r for r in suffix_dedup.drop_repeats(docs.where("doc_id in (6, 7)"), cut_text=True).collect()}
    assert out[7]["n_removed"] == out[7]["n_bytes"] == len(LONG) and out[7]["text"] == "" and out[7]["n_spans"] == 1
    assert out[6]["kept_bytes"].decode() == out[6]["text"]


# 6

def test_sharding_spreads_repeated_rows(spark):
    # half of the rows equal in doc_id and text (null), the others different
    rows = [(None, "the same text " * 4, i % 3) for i in range(3000)] + [(i, f"text {i} " * 6, 0) for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(4)
    out = sharding.shard(table, 4, bucket_bytes=1 << 14).collect()
    assert sorted((r["doc_id"] or -1, r["text"], r["part"]) for r in out) == sorted((r[0] or -1, r[1], r[2]) for r in rows)
    assert sorted(r["slot"] * 4 + r["shard"] for r in out) == list(range(6000))
    # buckets follow each other, so copies in one bucket would lie together
    tenths = Counter((r["slot"] * 4 + r["shard"]) // 600 for r in out if r["doc_id"] is None)
    assert all(200 < tenths[t] < 400 for t in range(10))
    again = sharding.shard(table, 4, bucket_bytes=1 << 14).collect()
    assert pairs(out, "doc_id", "text", "part", "shard", "slot") == pairs(again, "doc_id", "text", "part", "shard", "slot")


def test_sharding(docs, empty):
    out = sharding.shard(docs, 5, bucket_bytes=1 << 14)
    rows = out.collect()
    assert pairs(rows, "doc_id", "text") == sorted([(d, t) for d, t, _ in TEXTS], key=repr)
    per = Counter(r["shard"] for r in rows)
    assert set(per) == set(range(5)) and max(per.values()) - min(per.values()) <= 1
    for s in per:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(per[s]))
    assert all(r["size"] == len((r["text"] or "").encode()) + 16 and r["law"] == "rows" for r in rows)
    again = sharding.shard(docs, 5, bucket_bytes=1 << 14).collect()
    assert pairs(rows, "doc_id", "text", "shard", "slot") == pairs(again, "doc_id", "text", "shard", "slot")
    other = sharding.shard(docs, 5, seed=1, bucket_bytes=1 << 14).collect()
    assert pairs(rows, "doc_id", "text", "shard", "slot") != pairs(other, "doc_id", "text", "shard", "slot")
    assert sharding.shard(empty, 5).count() == 0


def test_written_shards_keep_slot_order(spark, docs, tmp_dir):
    sharding.write_shards(sharding.shard(docs, 3), f"{tmp_dir}/shards")
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert back.count() == len(TEXTS) and back.select("shard").distinct().count() == 3


# 7

def brute_components(rows):
    fps = [brute_fingerprint(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    least = {k: min((d for d in ds if d is not None), default=None) for k, ds in groups.items()}
    return sorted([(d, fps[i], least[find(i)]) for i, (d, _) in enumerate(rows)], key=repr)


@pytest.mark.parametrize("options", [{}, {"segments": 2}, {"segments": 5}, {"bucket_rows": 0}])
def test_near_duplicates_match_brute_force(spark, docs, options):
    import random
    rng = random.Random(3)
    base = [rng.choice("abcdefghij") * 3 for _ in range(60)]
    more = []
    for i in range(60):
        words = list(base)
        for _ in range(i % 5):
            words[rng.randrange(60)] = rng.choice("abcdefghij") * 3
        more.append((100 + i, " ".join(words)))
    rows = [(d, t) for d, t, _ in TEXTS if t != LONG] + more
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = simhash_dedup.near_duplicates(table, **options).collect()
    got = sorted([(r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in out], key=repr)
    assert got == brute_components(rows)


def test_components_of_a_long_chain(spark):
    n = 300
    nodes = spark.range(n).select(F.col("id").alias("node"))
    edges = spark.range(n - 1).select(F.pmod(F.col("id") * 7, F.lit(n)).alias("a"), F.pmod((F.col("id") + 1) * 7, F.lit(n)).alias("b"))
    out = simhash_dedup.components(nodes, edges).collect()
    assert len(out) == n and {r["root"] for r in out} == {0}


def test_keep_one_per_component(docs, empty):
    rows = simhash_dedup.keep_one_per_component(docs).collect()
    kept = Counter(r["doc_id"] for r in rows)
    want = {c for _, _, c in brute_components([(d, t) for d, t, _ in TEXTS if t != LONG])} | {6}
    assert set(kept) == want and max(kept.values()) == 1
    assert rows[0].__fields__ == docs.columns
    assert simhash_dedup.keep_one_per_component(empty).count() == 0


# 8

def test_targets(spark):
    table = spark.createDataFrame([(None, 10), ("a", 1000), ("b", 10), ("c", 10), ("d", 0)], "source string, source_size long")
    out = {r["source"]: r for r in source_mix.targets(table).collect()}
    assert [out[s]["weight"] for s in ("a", "b", "c", "d", None)] == [1, 2, 3, 1, 2]
    assert out["b"]["target"] == out["c"]["target"] == out[None]["target"] == 30 and out["d"]["target"] == 0
    assert out["a"]["target"] == 1030 - 90


def test_mix(docs, empty):
    rows = source_mix.mix(docs).collect()
    assert len(rows) == len(TEXTS)
    words = {(d, s): len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, s in TEXTS}
    total = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in TEXTS)
    assert all(r["size"] == words[r["doc_id"], r["source"]] and 0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert total - max(words.values()) <= sum(r["taken"] for r in rows) <= total
    again = source_mix.mix(docs.repartition(7)).collect()
    assert pairs(rows, "doc_id", "source", "taken") == pairs(again, "doc_id", "source", "taken")
    mixed = source_mix.take_mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["repeats"] for r in rows)
    assert source_mix.mix(empty).count() == 0 and source_mix.take_mix(empty).count() == 0
    assert {r["taken"] for r in source_mix.mix(docs.where("doc_id in (2, 3)")).collect()} == {0}


# 9, 10

def test_token_counts(docs, empty):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    got = pairs(out.collect(), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert got == sorted([(d, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for d, t, _ in TEXTS], key=repr)
    assert token_counts.count_tokens(empty, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_packing(docs, empty):
    import numpy as np
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, 2048, with_ids=True).collect()
    want = []
    for d, t, _ in TEXTS:
        ids = model.encode(t or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want += [(d, k, a, ids[a:e], zlib.crc32(np.array(ids[a:e], "<u4").tobytes())) for k, (a, e) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(want, key=repr) == sorted([(r["doc_id"], r["piece"], r["start"], list(r["ids"]), r["ids_crc32"]) for r in rows], key=repr)
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) == -(-sum(r["length"] for r in rows) // 2048)
    assert packing.pack(empty, path).count() == 0


# pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "SimHash near-dedup", "suffix-array dedup", "mixing sources to target weights", "best-fit packing"]
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    one = corpus_pipeline.STAGES[0][1](spark, docs, SF_SMALL)
    left = [(d, t) for d, t in rows if not rejected(t)]
    assert one.columns == docs.columns and pairs(one.collect(), "doc_id", "text") == sorted(left, key=repr)
    two = corpus_pipeline.STAGES[1][1](spark, one, SF_SMALL)
    keep = {c for _, _, c in brute_components(left)}
    left = [(d, t) for d, t in left if d in keep]
    assert two.columns == docs.columns and pairs(two.collect(), "doc_id", "text") == sorted(left, key=repr)
    three = corpus_pipeline.STAGES[2][1](spark, two, SF_SMALL)
    cut = [(d, kept.decode("utf-8", "ignore")) for d, n, gone, _, kept in brute_removed([(d, t.encode()) for d, t in left], 100)]
    cut = [(d, t) for d, t in cut if re.search(r"[^\x20\x09-\x0D]", t)]
    assert three.columns == docs.columns and pairs(three.collect(), "doc_id", "text") == sorted(cut, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in three.collect())
    four = corpus_pipeline.STAGES[3][1](spark, three, SF_SMALL)
    taken = {r["doc_id"]: r["repeats"] for r in source_mix.mix(three).collect()}
    assert four.columns == docs.columns
    assert Counter(r["doc_id"] for r in four.collect()) == Counter({d: n for d, n in taken.items() if n})
    five = corpus_pipeline.STAGES[4][1](spark, four, SF_SMALL).collect()
    assert Counter(r["doc_id"] for r in five if r["piece"] == 0) == Counter({d: n for d, n in taken.items() if n})


def test_pipeline_query_runs(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_pipeline_on_an_empty_table(spark, empty, tmp_dir):
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_dir}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0
