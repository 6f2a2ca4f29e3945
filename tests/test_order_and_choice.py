"""Numbers in file order, keep-one by hashes, quotas by threshold, folds without copies."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from quarry import sinks, sources
from quarry.operators import indexing


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.fixture()
def small_splits(spark):
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_rows_are_numbered_in_file_order_without_a_shuffle(spark, tmp_dir, small_splits):
    rng = random.Random(4)
    rows = [(f"{i}", "x\n" * rng.randrange(0, 40) + f'"{i}"') for i in range(150)]
    for part in range(3):
        with open(f"{tmp_dir}/part-{part}.csv", "w") as f:
            f.write("id,text\n" + "".join('{},"{}"\n'.format(i, t.replace('"', '""')) for i, t in rows[part * 50:part * 50 + 50]))
    read = sources.scan_delimited(spark, tmp_dir, ["id", "text"], position="at")
    out = indexing.number_in_place(read, "at", start=7, total_out="n")
    assert sorted((r["idx"], r["id"], r["text"], r["n"]) for r in out.collect()) == [(7 + i, *r, 150) for i, r in enumerate(rows)]
    # the only shuffles are those of stitched records and of one row per split
    assert "rangepartitioning" not in plan_of(out)
    some = indexing.dense_index(read.filter(F.col("id").cast("int") % 3 > 0), "at")
    assert sorted((r["idx"], r["id"]) for r in some.collect()) == list(enumerate(r[0] for r in rows if int(r[0]) % 3))
    lines = sources.scan_lines(spark, tmp_dir, position="p").select("value", "p._q_at")
    assert indexing.in_file_order(lines, "_q_at") and not indexing.in_file_order(lines, "value")
    with pytest.raises(Exception, match="file order"):
        indexing.number_in_place(read.repartition(5, "id"), "at").collect()


def test_global_offsets_are_sums_of_what_stands_before(spark):
    rows = [(i, (i * 7) % 5) for i in range(300)]
    got = indexing.global_offsets(spark.createDataFrame(rows, "k long, w long").repartition(6), "k", "w", total_out="all")
    want, total = {}, 0
    for k, w in rows:
        want[k] = total
        total += w
    assert {r["k"]: (r["offset"], r["all"]) for r in got.collect()} == {k: (v, total) for k, v in want.items()}


@pytest.mark.parametrize("keep", ["first", "last"])
def test_keep_one_with_ties_nulls_copies_and_a_hot_key(spark, keep):
    rng = random.Random(8)
    rows = [("hot" if i % 3 == 0 else rng.choice(["a", "b", "", None]), rng.choice([None, "x", ""]), rng.choice([None, -5, 0, 2 ** 62, 7]), f"v{i % 11}")
            for i in range(400)]
    rows += [("only null", "x", None, "v1"), ("only null", "x", None, "v2"), (None, "a", 1, "n"), ("a", None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, l string, o long, v string").repartition(5)
    out = indexing.keep_one_per_key(df, ["k", "l"], "o", keep=keep)
    assert "SortAggregate" not in plan_of(out) and out.columns == df.columns
    got = [tuple(r) for r in out.collect()]
    best = {}
    for k, l, o, _ in rows:
        if o is not None:
            best.setdefault((k, l), []).append(o)
    want = {key: (min if keep == "first" else max)(v) for key, v in best.items()}
    assert sorted(((r[0], r[1]) for r in got), key=repr) == sorted({(r[0], r[1]) for r in rows}, key=repr)
    assert all(r in rows and r[2] == want.get((r[0], r[1])) for r in got)
    again = indexing.keep_one_per_key(df.repartition(2), ["k", "l"], "o", keep=keep).collect()
    assert sorted((tuple(r) for r in again), key=repr) == sorted(got, key=repr)


def test_keep_one_by_other_orders(spark):
    rows = [("a", "2", 1), ("a", "10", 2), ("b", None, 3), ("b", "x", 4), ("c", None, 5)]
    df = spark.createDataFrame(rows, "k string, o string, v int")
    assert {r["k"]: r["v"] for r in indexing.keep_one_per_key(df, ["k"], "o").collect()} == {"a": 2, "b": 4, "c": 5}
    assert indexing.keep_one_per_key(df.limit(0), ["k"], "o").count() == 0


def test_drop_duplicate_pairs_keeps_the_first_and_numbers_it(spark):
    rng = random.Random(3)
    rows = [(f"t{rng.randrange(30)}", rng.choice([None, "u"]), i) for i in range(300)]
    df = spark.createDataFrame([(F_ord, s, t) for s, t, F_ord in rows] + [(5, *rows[5][:2])] * 3, "o int, s string, t string").repartition(4)
    df = df.withColumn("ord", F.struct(F.lit("b"), "o"))
    out = indexing.drop_duplicate_pairs(df, ["s", "t"], "ord", start=1)
    assert "SortAggregate" not in plan_of(out)
    seen, want = set(), []
    for s, t, i in rows:
        if (s, t) not in seen:
            seen.add((s, t))
            want.append((len(want) + 1, i, s, t))
    assert sorted((r["idx"], r["o"], r["s"], r["t"]) for r in out.collect()) == want


def test_quotas_by_threshold(spark):
    rng = random.Random(6)
    rows = [("big" if i % 10 < 8 else rng.choice(["g1", "g2", "g3"]), rng.choice([None, i, -i, 2 ** 63 - 1 - i, -2 ** 63 + i, 5]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o long, i int").repartition(6)
    quotas = {"big": 777, "g1": 3, "g2": 100_000, "g3": 0, "absent": 4}
    limits = spark.createDataFrame(list(quotas.items()), "g string, quota int")
    out = indexing.head_per_group(df, "g", "o", limits)
    assert out.columns == ["g", "o", "i"]
    got = [tuple(r) for r in out.collect()]

    def low_first(o):
        return (o is not None, o or 0)
    for g, quota in quotas.items():
        mine = [r[1] for r in rows if r[0] == g]
        assert sorted((r[1] for r in got if r[0] == g), key=low_first) == sorted(mine, key=low_first)[:quota]
    assert len({r[2] for r in got}) == len(got)
    assert sorted(map(repr, got)) == sorted(repr(tuple(r)) for r in indexing.head_per_group(df.repartition(3), "g", "o", limits).collect())
    words = df.withColumn("o", F.col("o").cast("string"))
    got = [tuple(r) for r in indexing.head_per_group(words, "g", "o", limits).collect()]
    for g, quota in quotas.items():
        mine = [None if r[1] is None else str(r[1]) for r in rows if r[0] == g]
        key = lambda o: (o is not None, o or "")
        assert sorted((r[1] for r in got if r[0] == g), key=key) == sorted(mine, key=key)[:quota]


def test_folds_are_written_once_and_read_as_sets(spark, tmp_dir):
    rows = [(i, f' text\n"{i}" ' * 50, i % 4 + 1) for i in range(200)]
    df = spark.createDataFrame(rows, "idx long, source string, fold int")
    sinks.write_fold_table(df, tmp_dir + "/f", 4)
    sinks.write_delimited(df.drop("fold"), tmp_dir + "/plain")
    size = lambda d: sum(os.path.getsize(p) for p in glob.glob(f"{d}/**/*.csv", recursive=True))
    assert size(tmp_dir + "/f") < 1.05 * size(tmp_dir + "/plain")
    got = sorted(tuple(r) for r in sources.scan_folds(spark, tmp_dir + "/f").collect())
    assert got == sorted((f, "dev" if g == f else "train", str(i), t) for i, t, g in rows for f in range(1, 5))
    one = sources.scan_folds(spark, tmp_dir + "/f", fold=2, split="dev")
    assert sorted(r["idx"] for r in one.collect()) == sorted(str(i) for i, _, g in rows if g == 2)
    with pytest.raises(ValueError):
        sources.scan_folds(spark, tmp_dir + "/f", fold=9)
