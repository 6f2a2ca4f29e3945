"""Global index, folds, hold-out and rescaling: invariants and exact values."""

import math

from pyspark.sql import functions as F

from quarry.operators import indexing


def test_global_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    out = indexing.global_index(df, "k", out="idx", start=1, num_partitions=5).collect()
    pairs = sorted((r["k"], r["idx"]) for r in out)
    assert [i for _, i in pairs] == list(range(1, 5001))


def test_group_row_number_skewed_group(spark):
    # one label holds most rows; numbering must still be exact per group
    df = spark.range(0, 3000).select(F.when(F.col("id") % 10 < 8, "big").otherwise(
        F.concat(F.lit("g"), (F.col("id") % 3).cast("string"))).alias("g"), F.col("id"))
    out = indexing.group_row_number(df, ["g"], "id", out="rn", num_partitions=6).collect()
    by = {}
    for r in out:
        by.setdefault(r["g"], []).append((r["id"], r["rn"]))
    for rows in by.values():
        rows.sort()
        assert [rn for _, rn in rows] == list(range(1, len(rows) + 1))


def test_kfold_sizes_like_kfold(spark):
    n, k = 103, 10
    out = indexing.kfold_contiguous(spark.range(n), "id", k=k).collect()
    fold = {r["id"]: r["fold"] for r in out}
    sizes = [sum(1 for f in fold.values() if f == i) for i in range(1, k + 1)]
    assert sizes == [11, 11, 11] + [10] * 7
    # contiguous: folds never decrease along the order
    assert all(fold[i] <= fold[i + 1] for i in range(n - 1))


def test_holdout_split_size_and_repeatable(spark):
    df = spark.range(0, 997).withColumnRenamed("id", "idx")
    a = indexing.holdout_split(df, "idx", k=10)
    b = indexing.holdout_split(df.repartition(13), "idx", k=10)
    ra = sorted(tuple(r) for r in a.collect())
    rb = sorted(tuple(r) for r in b.collect())
    assert ra == rb
    test = [r for r in ra if r[1] == "test"]
    assert len(test) == math.ceil(0.05 * 997)
    train_folds = [r[2] for r in ra if r[1] == "train"]
    assert sorted(set(train_folds)) == list(range(1, 11))


def test_folds_and_holdout_cut_tied_keys_at_exact_positions(spark):
    # keys held by a third of the rows, by exact copies, by null, and by two rows each
    rows = [(7, f"t{i}") for i in range(50)] + [(9, "copy")] * 40 + [(None, f"n{i}") for i in range(13)]
    rows += [(100 + i // 2, f"p{i}") for i in range(47)]
    df = spark.createDataFrame(rows, "idx long, text string").repartition(5)
    n, k = len(rows), 10
    sizes = [n // k + (i < n % k) for i in range(k)]
    out = [tuple(r) for r in indexing.kfold_contiguous(df, "idx", k=k).collect()]
    assert sorted(r[:2] for r in out if r[0] is not None) == sorted(r for r in rows if r[0] is not None)
    assert [sum(r[2] == f for r in out) for f in range(1, k + 1)] == sizes
    in_order = sorted(out, key=lambda r: (r[2], r[0] is not None, r[0] or 0))
    assert [r[0] for r in in_order] == [r[0] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    again = [tuple(r) for r in indexing.kfold_contiguous(df.repartition(2), "idx", k=k, num_partitions=3).collect()]
    assert sorted(again, key=repr) == sorted(out, key=repr)

    for fraction in (0.05, 0.3, 0.5):
        split = indexing.holdout_split(df, "idx", test_fraction=fraction, k=4)
        assert split.columns == ["idx", "text", "split", "fold"]
        split = [tuple(r) for r in split.collect()]
        test = math.ceil(fraction * n)
        assert sum(r[2] == "test" for r in split) == test and all((r[3] is None) == (r[2] == "test") for r in split)
        train = n - test
        assert [sum(r[3] == f for r in split) for f in range(1, 5)] == [train // 4 + (i < train % 4) for i in range(4)]
    one = indexing.kfold_contiguous(spark.createDataFrame([(1,)] * 7, "idx long"), "idx", k=3).collect()
    assert sorted(r["fold"] for r in one) == [1, 1, 1, 2, 2, 3, 3]


def test_rescale_quotas_match_reference_rule(spark):
    counts = {"support": 300, "deny": 40, "comment": 80, "unrelated": 900}
    rows = [(i, lbl) for lbl, n in counts.items() for i in range(n)]
    df = spark.createDataFrame([(lbl + str(i), lbl, j) for j, (i, lbl) in enumerate(rows)],
                               "id string, stance string, ord long")
    got = {r["stance"]: r["n"] for r in indexing.rescale_to_distribution(df, "stance", "ord")
           .groupBy("stance").agg(F.count("*").alias("n")).collect()}
    dist = dict(indexing.RESCALE_DISTRIBUTION)
    expect = None
    for anchor in dist:
        sizes = {anchor: counts[anchor]}
        for lbl in dist:
            if lbl != anchor:
                size = dist[lbl] / dist[anchor] * counts[anchor]
                if size <= counts[lbl]:
                    sizes[lbl] = size
                else:
                    break
        if len(sizes) == len(dist):
            expect = sizes
            break
    assert got == {lbl: min(counts[lbl], int(s) + 1) for lbl, s in expect.items()}


def test_keep_one_per_key_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z")], "k string, o int, v string")
    first = {r["k"]: r["v"] for r in indexing.keep_one_per_key(df, ["k"], "o").collect()}
    last = {r["k"]: r["v"] for r in indexing.keep_one_per_key(df, ["k"], "o", keep="last").collect()}
    assert first == {"a": "x", "b": "z"} and last == {"a": "y", "b": "z"}


def test_pipelines_independent_of_shuffle_partitions(spark):
    import __spark_entry__ as entry
    from conftest import SF_SMALL
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            q = entry.queries()
            results.append([sorted(tuple(r) for r in q[k](spark, SF_SMALL).collect())
                            for k in ("pipeline_stance", "pipeline_rumour_threads")])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]
