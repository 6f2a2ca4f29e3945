"""Operators 11 to 13 against plain Python, and their defined odd cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import decontamination, registered, resampling, whitening

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def scribble(rng, n, letters):
    return "".join(rng.choice(letters) + rng.choice([" ", ", ", "\n", "-", "\r\n"]) for _ in range(n))


def texts_and_items(seed):
    rng = random.Random(seed)
    docs = [(i, scribble(rng, rng.randrange(0, 60), ["a", "B", "c", "é", "9"][:2 + i % 4])) for i in range(120)]
    docs += [(None, None), (5, ""), (5, "... !!"), (7, "a B-a"), (7, "a B-a"), (None, "A b c"), (900, "é c " * 4000), (901, "x　y Ünï 1")]
    items = [(i, scribble(rng, rng.choice([0, 1, 2, 3, 8, 9, 11, 14]), ["a", "B", "c", "é", "9"][:2 + i % 4])) for i in range(40)]
    return docs, items + [(None, "é c é"), (7, None), (7, ""), (8, "Ünï"), (3, "9 9 a")]


# 11

def brute_marks(docs, items, window):
    windows = {}
    for name, text in items:
        own = words(text)
        k = min(window, len(own))
        for j in range(len(own) - k + 1 if own else 0):
            windows.setdefault(tuple(own[j:j + k]), set()).add("null" if name is None else str(name))
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for k in {len(w) for w in windows}:
            for j in range(len(own) - k + 1):
                names = windows.get(tuple(own[j:j + k]))
                if names:
                    found |= names
                    hit |= set(range(j, j + k))
        out.append((doc, len(own), len(hit), sorted(found)))
    return sorted(out, key=repr)


def marks(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in df.collect()), key=repr)


@pytest.mark.parametrize("window", [1, 2, 10])
def test_decontamination_finds_every_window(spark, window):
    docs, items = texts_and_items(window)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    want = brute_marks(docs, items, window)
    assert marks(decontamination.mark_contamination(d, i, window)) == want
    assert marks(decontamination.mark_contamination(d, i, window, shard_bytes=50)) == want
    blocks = decontamination.mark_contamination(d, i, window, block_bytes=400)
    assert marks(blocks) == want
    whole = {(r["doc_id"], r["n_words"]): r for r in decontamination.mark_contamination(d, i, window).collect()}
    for r in blocks.collect():
        assert [tuple(s) for s in r["hit_words"]] == [tuple(s) for s in whole[r["doc_id"], r["n_words"]]["hit_words"]]
        assert sum(s["last"] - s["first"] + 1 for s in r["hit_words"]) == r["n_hit"]


def test_longest_match_goes_beyond_the_window(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    d = spark.createDataFrame([(1, f"start {passage} end"), (2, "w5 w6 w7 w8"), (3, f"{passage[:40]} other")], "doc_id long, text string")
    i = spark.createDataFrame([(1, passage + " more"), (2, "w3 w4 w5 w6 W7 w8 w9")], "item_id long, text string")
    got = {r["doc_id"]: (r["longest_match"], r["items"]) for r in decontamination.mark_contamination(d, i, 5).collect()}
    assert got == {1: (30, ["1", "2"]), 2: (0, []), 3: (len(passage[:40].split()) - (passage[40] != " "), ["1", "2"])}


def test_decontamination_removes_and_keeps_columns(spark):
    schema = "doc_id long, text string, items string, __llm_row string, n_words int, name string"
    rows = [(1, "one two three", "mine", "r", 3, "n"), (2, "clean text", None, None, None, None), (3, None, "x", "y", 1, "z")]
    d = spark.createDataFrame(rows, schema)
    i = spark.createDataFrame([(1, "ONE two three")], "item_id long, text string")
    left = decontamination.decontaminate(d, i)
    assert left.schema == d.schema and sorted(tuple(r) for r in left.collect()) == sorted(rows[1:])
    empty = spark.createDataFrame([], schema)
    assert decontamination.mark_contamination(empty, i).count() == 0
    assert decontamination.decontaminate(d, i.limit(0)).count() == 3


def test_suffix_array_is_sorted_to_the_depth():
    rng = np.random.default_rng(5)
    for depth in (1, 2, 5, 16):
        symbols = np.append(rng.integers(0, 4, 300), 0)
        order = decontamination.suffix_array(symbols, depth)
        assert sorted(order.tolist()) == list(range(301))

        def key(p):
            rest = symbols[p:p + depth].tolist()
            return rest[:rest.index(0)] if 0 in rest else rest
        keys = [key(p) for p in order.tolist()]
        assert keys == sorted(keys)


# 12

def brute_resample(docs, target, grams, buckets=10_000, least=20, percent=10):
    def features(text):
        own = words(text)
        return [zlib.crc32(" ".join(own[i:i + k]).encode()) % buckets for k in range(1, grams + 1) for i in range(len(own) - k + 1)]
    corpus = [features(t) for _, t in docs]
    s, t = Counter(x for f in corpus for x in f), Counter(x for _, text in target for x in features(text))
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for (doc, text), f in zip(docs, corpus, strict=True):
        weight = sum(math.floor(1000 * math.log((t[x] + 1) * (s_all + buckets) / ((s[x] + 1) * (t_all + buckets)))) for x in f)
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = i + 1
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("grams,percent", [(1, 10), (2, 35), (4, 100)])
def test_resampling_as_counted_plainly(spark, grams, percent):
    docs, target = texts_and_items(20 + grams)
    docs += [(1000 + i, "one line that stands everywhere\n" * (i % 3) + f"own {i} words\n\n and é{i} more " * 3) for i in range(60)]
    d = spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, source string").repartition(4)
    i = spark.createDataFrame(target, "item_id long, text string")
    got = resampling.resample(d, i, grams=grams, percent=percent)
    assert got.columns == ["doc_id", "source", *resampling.OUTPUTS]
    found = sorted((tuple(r[c] for c in ("doc_id", *resampling.OUTPUTS)) for r in got.collect()), key=repr)
    assert found == brute_resample(docs, target, grams, percent=percent)


def test_lines_without_frequent_ones_are_joined_alike(spark, monkeypatch):
    docs, target = texts_and_items(3)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(target, "item_id long, text string")
    want = brute_resample(docs, target, 1)
    for frequent in (0, 1 << 40):  # none is broadcast, all are
        monkeypatch.setattr(resampling, "FREQUENT", frequent)
        got = resampling.resample(d, i).select("doc_id", *resampling.OUTPUTS)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_resampling_of_empty_tables_and_clashing_columns(spark):
    d = spark.createDataFrame([(1, "a b " * 30, 5, "r", "h", 1.5), (None, None, None, None, None, None)],
                              "doc_id long, text string, rank int, row string, head string, k1 double")
    none = spark.createDataFrame([], "item_id long, text string")
    got = resampling.resample(d, none, percent=100)
    assert {(r["doc_id"], r["n_words"], r["rank"], r["row"], r["k1"]) for r in got.collect()} == {(1, 60, 1, "r", 1.5), (None, 0, None, None, None)}
    assert resampling.resample(d.limit(0), none).count() == 0


# 13

def vectors(rng, n, d):
    return (rng.standard_normal((n, d)) * np.linspace(2, 0.1, d)).astype(np.float32)


def test_whitening_as_defined(spark):
    rng = np.random.default_rng(2)
    e = vectors(rng, 300, 40)
    rows = [(i, [float(x) for x in v], "keep") for i, v in enumerate(e)] + [(7, [float(x) for x in e[7]], "again")] * 20
    bad = [(500, None, "a"), (501, [float("nan")] + [0.0] * 39, "a"), (502, [float("inf")] + [0.0] * 39, "a"), (503, [None] + [0.0] * 39, "a"),
           (504, [], "a"), (505, [1.0, 2.0], "a"), (None, [0.5] * 40, None)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, deviation string").repartition(5)
    x = np.floor(64 * np.array([r[1] for r in rows] + [[0.5] * 40], dtype=np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    model = whitening.fit_whitening(df)
    assert (model.n, list(model.sums)) == (n, sums.tolist())
    assert np.allclose(model.values, values[:32], rtol=1e-9) and model.identity_error < 1e-9
    assert np.allclose(model.explained, values[:32] / values.sum(), rtol=1e-9)
    ids = [r[0] for r in rows] + [None]
    want = {i: (int(((n * v - sums) ** 2).sum()), c @ axes[:, :32] / np.sqrt(values[:32])) for i, v, c in zip(ids, x, centred, strict=True)}
    got = whitening.whiten(df, model)
    assert got.columns == ["vec_id", "embedding", "deviation", "whitened"]
    taken = got.collect()
    assert sorted((r["vec_id"] for r in taken), key=repr) == sorted(ids, key=repr)
    for r in taken:
        deviation, w = want[r["vec_id"]]
        assert int(r["deviation"]) == deviation and np.allclose(np.abs(r["whitened"]), np.abs(w), atol=1e-7)
    both = np.array([r["whitened"] for r in taken])
    assert np.allclose(both.T @ both / n, np.eye(32), atol=1e-6)  # one sign for all rows


def test_whitening_of_few_flat_and_large_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.fit_whitening(spark.createDataFrame([], schema)) is None
    one = spark.createDataFrame([(1, [1.0, 2.0])], schema)
    model = whitening.fit_whitening(one)
    assert len(model.values) == 0 and [(int(r["deviation"]), r["whitened"]) for r in whitening.whiten(one, model).collect()] == [(0, [])]
    # two dimensions say the same, one says nothing: a single component is left
    flat = spark.createDataFrame([(i, [float(i), float(i), 3.0]) for i in range(9)], schema)
    model = whitening.fit_whitening(flat)
    assert len(model.values) == 1 and abs(model.explained[0] - 1) < 1e-12 and model.identity_error < 1e-9
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [2.0, 5.0])], schema)
    model = whitening.fit_whitening(huge)
    x = [[int(min(max(c, -whitening.MOST), whitening.MOST) * 64) + 1_000_000 for c in v] for v in ([1e300, 0], [-1e300, 1], [2, 5])]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert sorted(int(r["deviation"]) for r in whitening.whiten(huge, model).collect()) == sorted(
        sum((3 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x)


@pytest.mark.parametrize("d", [1, 2, 3, 17, 80])
def test_eigenvectors_by_bisection_and_inverse_iteration(d):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d, d))
    q = np.linalg.qr(a)[0]
    close = q @ np.diag(np.repeat([5.0, 5.0 - 1e-9, 1.0], -(-d // 3))[:d]) @ q.T
    for m in (a @ a.T, (close + close.T) / 2, np.diag(np.arange(d) + 1.0), np.eye(d)):
        values, unit = whitening.leading_components(m, 32)
        assert np.allclose(values, np.linalg.eigvalsh(m)[::-1][:32], atol=1e-12 * np.abs(m).max() * d)
        assert np.allclose(unit.T @ unit, np.eye(len(values)), atol=1e-10)
        assert np.allclose(m @ unit, unit * values, atol=1e-11 * np.abs(m).max() * d)


def test_new_queries_run_on_the_shared_tables(spark):
    from conftest import SF_SMALL
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = registered.QUERIES["op11_benchmark_decontamination"](spark, SF_SMALL).collect()
    want = [(d, w, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, w, h, i in brute_marks(docs, items, 10)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    got = registered.QUERIES["op12_importance_resampling"](spark, SF_SMALL).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((r[0], *r[2:]) for r in brute_resample(docs, items, 1)), key=repr) and len(got) == n
    got = registered.QUERIES["op13_embedding_whitening"](spark, SF_SMALL)
    row = got.agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n"), F.max("component").alias("k"), F.max("identity_error").alias("e")).first()
    assert row["rows"] == 32 * row["n"] and row["k"] == 32 and row["e"] <= 1e-4
