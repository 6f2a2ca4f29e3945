import pytest
"""File layouts: raw trees written by Python, Spark round trips."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry import sinks, sources


def test_delimited_round_trip_quotes_and_newlines(spark, tmp_dir):
    rows = [("1", 'He said "hi",\nthen left'), ("2", ""), ("3", "tab\there")]
    df = spark.createDataFrame(rows, "a string, b string")
    path = os.path.join(tmp_dir, "csv")
    sinks.write_delimited(df, path, sep="\t", header=True)
    back = sources.scan_delimited(spark, path, ["a", "b"], sep="\t", header=True)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_article_tree_raw_layout(spark, tmp_dir):
    root = os.path.join(tmp_dir, "fnn")
    for label, nid, has_content in (("fake", "n1", True), ("real", "n2", True), ("fake", "n3", False)):
        d = os.path.join(root, "politifact", label, nid)
        os.makedirs(os.path.join(d, "tweets"))
        if has_content:
            with open(os.path.join(d, "news content.json"), "w") as f:
                json.dump({"url": f"http://{nid}.com/a", "title": f"T {nid}",
                           "meta_data": {"description": "D"} if nid == "n1" else {}}, f, indent=2)
        with open(os.path.join(d, "tweets", "1.json"), "w") as f:
            json.dump({"id": 1, "text": "hi", "entities": {"urls": [{"expanded_url": "http://x.org/p"}]}}, f)
    arts, posts = sources.scan_article_tree(spark, root)
    got = sorted((r["news_label"], r["news_id"], r["title"], r["description"]) for r in arts.collect())
    assert got == [("fake", "n1", "T n1", "D"), ("real", "n2", "T n2", "")]
    # posts of an article without content file stay: the url counts need them
    assert sorted(r["news_id"] for r in posts.collect()) == ["n1", "n2", "n3"]


def test_thread_tree_raw_layout(spark, tmp_dir):
    root = os.path.join(tmp_dir, "re")
    for folder, pid, text in (("source-tweet", 10, "src"), ("replies", 11, "reply"), ("replies", 10, "dup")):
        d = os.path.join(root, "topic", "10", folder)
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"{pid}-{text}.json"), "w") as f:
            json.dump({"id": pid, "text": text}, f)
    posts = sources.keep_source_text(sources.scan_thread_tree(spark, root))
    assert sorted((r["post"], r["text"]) for r in posts.collect()) == [("10", "src"), ("11", "reply")]


def test_reply_edges_from_nested_json(spark):
    s = json.dumps({"1": {"2": {"4": []}, "3": []}})
    df = spark.createDataFrame([("t", s)], "thread string, structure string")
    got = sorted(tuple(r) for r in sources.scan_reply_edges(df).collect())
    assert got == [("t", "1", "2"), ("t", "1", "3"), ("t", "2", "4")]


def test_sentence_pairs_strict(spark):
    df = spark.createDataFrame([("1\ta\tb\ts one\ts two \n",)], "value string")
    assert [tuple(r) for r in sources.scan_sentence_pairs(df).collect()] == [("1", "a", "b", "s one", "s two")]


def test_logits_document(spark, tmp_dir):
    path = os.path.join(tmp_dir, "logits.json")
    with open(path, "w") as f:
        json.dump([[1.0, 2.0, 3.0], [0.5, 0.1, 0.2]], f)
    rows = sorted(tuple(r) for r in sources.read_logits_file(spark, path).collect())
    assert rows == [(0, [1.0, 2.0, 3.0]), (1, [0.5, 0.1, 0.2])]


def test_write_folds_layout(spark, tmp_dir):
    df = spark.range(0, 20).select(F.col("id").alias("idx"), (F.col("id") % 4 + 1).alias("fold"))
    path = os.path.join(tmp_dir, "folds")
    sinks.write_folds(df, path, k=4)
    back = spark.read.option("header", "true").option("sep", "\t").csv(path)
    counts = {(r["fold"], r["split"]): r["count"] for r in back.groupBy("fold", "split").count().collect()}
    assert all(counts[(f, "dev")] == 5 and counts[(f, "train")] == 15 for f in range(1, 5))


def test_url_manifest_raw_layout(spark, tmp_dir):
    root = os.path.join(tmp_dir, "re17")
    for thread, rows in (("500", [("u1", "t.co/a", "http://a.com/x")]),
                         ("501", [("u2", "t.co/b", "http://b.org/y"), ("u3", "", "http://c.net/")])):
        d = os.path.join(root, "topic", thread)
        os.makedirs(d)
        with open(os.path.join(d, "urls.dat"), "w") as f:
            for r in rows:
                f.write("\t".join(r) + "\n")
    got = sorted(tuple(r) for r in sources.scan_url_manifest(spark, f"{root}/*/*/urls.dat").collect())
    assert got == [("500", "u1", "t.co/a", "http://a.com/x"), ("501", "u2", "t.co/b", "http://b.org/y"),
                   ("501", "u3", "", "http://c.net/")]


def test_label_maps_flat_and_nested(spark):
    df = spark.createDataFrame([('{"1": "support", "2": "deny"}',), ('{"3": "comment"}',)], "value string")
    nested = spark.createDataFrame([('{"subtaskaenglish": {"2": "query"}}',)], "value string")
    flat = {(r["post"], r["label"]) for r in sources.scan_label_maps(df).collect()}
    deep = {(r["post"], r["label"]) for r in sources.scan_label_maps(nested, nested_key="subtaskaenglish").collect()}
    assert flat == {("1", "support"), ("2", "deny"), ("3", "comment")} and deep == {("2", "query")}


def test_reply_edges_deep_chain(spark):
    depth = 60
    tree = "[]"
    for node in range(depth, 0, -1):
        tree = json.dumps({str(node): json.loads(tree)})
    df = spark.createDataFrame([("t", json.dumps({"0": json.loads(tree)}))], "thread string, structure string")
    got = sorted(((int(r["parent"]), int(r["node"])) for r in sources.scan_reply_edges(df).collect()))
    assert got == [(i, i + 1) for i in range(depth)]


def test_reply_trees_of_any_depth_and_broken_ones(spark):
    deep = "".join(f'{{"{i}": ' for i in range(1500)) + "[]" + "}" * 1500
    df = spark.createDataFrame([("t", deep), ("u", None)], "thread string, structure string")
    got = {(int(r["parent"]), int(r["node"])) for r in sources.scan_reply_edges(df).collect()}
    assert got == {(i, i + 1) for i in range(1499)}
    listed = spark.createDataFrame([("t", '{"1": {"2": [{"9": {}}], "3\\"": "x"}}')], "thread string, structure string")
    assert sorted((r["parent"], r["node"]) for r in sources.scan_reply_edges(listed).collect()) == [("1", "2"), ("1", '3"')]
    for bad in ('{"1": ', "{1}", '{"a" 1}', '{"a": {}} x', ""):
        with pytest.raises(Exception, match="reply structure"):
            sources.scan_reply_edges(spark.createDataFrame([("t", bad)], "thread string, structure string")).collect()


def test_broken_json_fails(spark, tmp_dir):
    text = spark.createDataFrame([('{"1": "support"',)], "value string")
    with pytest.raises(Exception):
        sources.scan_label_maps(text).collect()
    with pytest.raises(Exception):
        sources.scan_logits(spark.createDataFrame([("[[1.0, x]]",)], "value string")).collect()
    with open(os.path.join(tmp_dir, "a.json"), "w") as f:
        f.write('{"url": ')
    with pytest.raises(Exception):
        sources.scan_json_objects(spark, tmp_dir, "url string").collect()


def test_delimited_round_trip_keeps_blanks(spark, tmp_dir):
    rows = [("  lead trail  ", "a"), ("\ttab\t", ""), ("", "x"), ('say "hi", you', " \n "), ("cr\rlf", "\u2003em ")]
    sinks.write_delimited(spark.createDataFrame(rows, "a string, b string"), f"{tmp_dir}/out")
    back = sources.scan_delimited(spark, f"{tmp_dir}/out", ["a", "b"])
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_fold_files_row_by_row(spark, tmp_dir):
    rows = [(i, f" text {i} ", i % 3 + 1) for i in range(9)]
    sinks.write_folds(spark.createDataFrame(rows, "idx long, source string, fold int"), f"{tmp_dir}/folds", 3)
    for fold in (1, 2, 3):
        for split in ("dev", "train"):
            got = sources.scan_delimited(spark, f"{tmp_dir}/folds/fold={fold}/split={split}", ["idx", "source"], sep="\t")
            assert sorted(tuple(r) for r in got.collect()) == sorted(
                (str(i), t) for i, t, f in rows if (f == fold) == (split == "dev"))


def test_lines_by_python_boundaries(spark, tmp_dir):
    text = "a\x0bb\r\nc\rd\u2028e\n\nf\x85g\n"
    with open(os.path.join(tmp_dir, "x.txt"), "w", encoding="utf-8", newline="") as f:
        f.write(text)
    rows = sources.scan_lines(spark, tmp_dir, position="at").orderBy("at").collect()
    assert [r["value"] for r in rows] == ["a", "b", "c", "d", "e", "", "f", "g"]


def test_stance_corpus_last_body_by_file_order(spark, tmp_dir):
    for name, body in (("bodies", "id,body\n1,first\n2,other\n1,last\n"), ("stances", "h,id,s\nhead,1,agree\n")):
        os.makedirs(f"{tmp_dir}/{name}")
        with open(f"{tmp_dir}/{name}/x.csv", "w") as f:
            f.write(body)
    from quarry.operators import joins, labels
    b, s = sources.scan_stance_corpus(spark, f"{tmp_dir}/bodies", f"{tmp_dir}/stances")
    assert [r["source"] for r in joins.join_stance_bodies(labels.map_stance_article(s), b).collect()] == ["last"]


def test_sentence_pair_files_lose_their_header_lines(spark, tmp_dir):
    head = "Quality\t#1 ID\t#2 ID\t#1 String\t#2 String"
    for name, ids in (("a b.txt", [1, 2, 3]), ("c.txt", [4])):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("\n".join([head] + [f"1\t{i}\t{i + 10}\ts {i}\tt {i} " for i in ids]) + "\n")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("20", kept):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = sources.read_sentence_pairs(spark, tmp_dir)
            assert sorted(tuple(r) for r in got.collect()) == [("1", str(i), str(i + 10), f"s {i}", f"t {i}") for i in (1, 2, 3, 4)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_annotation_batches_keep_folder_names_as_text(spark, tmp_dir):
    df = spark.createDataFrame([("01", "fake", 7, 'a\n"b"'), ("1", "real", 8, ""), ("x", "fake", 9, "c")],
                               "batch string, news_label string, doc_id long, source string")
    df.write.partitionBy("batch", "news_label").parquet(f"{tmp_dir}/p")
    got = sources.scan_annotation_batches(spark, f"{tmp_dir}/p").select(*df.columns)
    assert got.schema["batch"].dataType.simpleString() == "string" and sorted(got.collect()) == sorted(df.collect())
    (df.write.partitionBy("batch", "news_label").option("header", "true").option("quote", '"').option("escape", '"').csv(f"{tmp_dir}/c"))
    for columns in (None, ["doc_id", "source"]):
        got = sources.scan_annotation_batches(spark, f"{tmp_dir}/c", "csv", columns).select(*df.columns)
        assert sorted((r[0], r[1], r[2], r[3] or "") for r in got.collect()) == sorted((r[0], r[1], str(r[2]), r[3]) for r in df.collect())


def test_logits_file_is_cut_anywhere(spark, tmp_dir):
    import json
    rng = __import__("random").Random(3)
    docs = {"a b.json": [[rng.uniform(-9, 9), float(rng.randrange(5)), rng.uniform(0, 1) * 1e-7] for _ in range(70)],
            "c.json": [[1, -2, 3.5]], "empty.json": []}
    for i, (name, rows) in enumerate(docs.items()):
        with open(f"{tmp_dir}/{name}", "w") as f:
            json.dump(rows, f, indent=[None, 1][i % 2])
            f.write("\n" * i)
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (17, 200, 10_000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            got = {}
            for r in sources.read_logits_file(spark, tmp_dir, file_out="file").collect():
                got.setdefault(os.path.basename(r["file"]).replace("%20", " "), {})[r["idx"]] = list(r["logits"])
            assert {n: [v[i] for i in range(len(v))] for n, v in got.items()} == {n: rows for n, rows in docs.items() if rows}
        with open(f"{tmp_dir}/c.json", "w") as f:
            f.write("[[1, 2], [3, x]]")
        with pytest.raises(Exception, match="not a row of logits"):
            sources.read_logits_file(spark, tmp_dir).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _staged(spark, monkeypatch, tmp_dir, query):
    """Rows of a query that stages files, and the folders of those files."""
    from quarry.plans import queries
    monkeypatch.setattr(queries, "staging_path", lambda spark, name: os.path.join(tmp_dir, name))
    rows = queries.registry()[query](spark, SF_SMALL).collect()
    return rows, [os.path.relpath(at, tmp_dir) for at, _, files in os.walk(tmp_dir) if any(f.startswith("part-") for f in files)]


def test_article_tree_is_staged_in_a_folder_per_label(spark, monkeypatch, tmp_dir):
    rows, folders = _staged(spark, monkeypatch, tmp_dir, "scan_article_tree")
    assert len(rows) > 4 and len({r["news_id"] for r in rows}) == len(rows)
    assert sorted(folders) == [f"articles/{kind}/dataset=politifact/news_label={side}"
                               for kind in ("articles", "posts") for side in ("fake", "real")]


def test_url_manifest_is_staged_in_few_files(spark, monkeypatch, tmp_dir):
    rows, folders = _staged(spark, monkeypatch, tmp_dir, "scan_url_manifest")
    assert len({r["thread"] for r in rows}) > 4 and folders == ["manifest"]


def test_url_manifest_table_layout(spark, tmp_dir):
    path = os.path.join(tmp_dir, "manifest")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write("500\tu1\tt.co/a\thttp://a.com/x\n501\tu3\t\t\n")
    got = sorted(tuple(r) for r in sources.scan_url_manifest(spark, path, layout="table").collect())
    assert got == [("500", "u1", "t.co/a", "http://a.com/x"), ("501", "u3", "", "")]


def test_sentence_pair_files_lose_their_header_without_a_shuffle(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pairs")
    os.makedirs(path)
    for n in range(3):
        with open(os.path.join(path, f"part-{n}.txt"), "w") as f:
            f.write(f"Quality\t#1 ID\t#2 ID\t#1 String\t#2 String\n1\t{n}\tb\ts one\ts two\n")
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as where the tables are large
    try:
        got = sources.read_sentence_pairs(spark, path)
        assert "SortMergeJoin" not in got._jdf.queryExecution().sparkPlan().toString()
        assert sorted(r["id1"] for r in got.collect()) == ["0", "1", "2"]
    finally:
        spark.conf.set(key, old)


def test_sentence_pairs_are_staged_compressed_by_one_job(spark, monkeypatch, tmp_dir):
    rows, folders = _staged(spark, monkeypatch, tmp_dir, "pipeline_sentence_pairs")
    assert {r["split"] for r in rows} == {"train", "dev", "test"}
    assert sorted(folders) == ["sentence-pairs/file=test", "sentence-pairs/file=train"]
    files = [f for _, _, names in os.walk(tmp_dir) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)


def test_sentence_pair_lines_shuffle_each_text_once(spark, tmp_dir):
    from quarry.plans import fixtures
    docs = [(i, f"text\n{i}") for i in (-65, -64, -63, -1, 0, 1, 62, 63, 64, 65, 127, 128, 300)]
    docs += [(64, "other 64"), (64, "other 64"), (0, None), (None, "no id"), (None, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    lines = fixtures.fx_pair_lines(spark, tmp_dir)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    flat = [(i, t and t.replace("\n", " ")) for i, t in docs if i is not None]
    want = ["\t".join(x for x in (str(i % 2 if i >= 0 else -(-i % 2)), str(i), str(j), s, t) if x is not None) for i, s in flat for j, t in flat if j == i + 1]
    assert len(want) > 12 and sorted(r["value"] for r in lines.collect()) == sorted(want)


def test_pairs_are_not_shuffled_to_their_dev_ids(spark, monkeypatch):
    from quarry.operators import joins
    pairs = spark.createDataFrame([(str(i), str(i + 1), f"s{i}") for i in range(20)] + [(None, "1", "none")], "id1 string, id2 string, s1 string")
    dev = spark.createDataFrame([("3", "4"), ("3", "4"), ("9", "1"), (None, "1")], "id1 string, id2 string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as where the tables are large
    try:
        for most, join in ((joins.BROADCAST_KEYS_BYTES, "BroadcastHashJoin"), (0, "SortMergeJoin")):
            monkeypatch.setattr(joins, "BROADCAST_KEYS_BYTES", most)
            got = joins.pair_semi_anti_split(pairs, dev)
            assert join in got._jdf.queryExecution().sparkPlan().toString()
            rows = got.collect()
            assert len(rows) == 21 and [(r["id1"], r["s1"]) for r in rows if r["split"] == "dev"] == [("3", "s3")]
    finally:
        spark.conf.set(key, old)
