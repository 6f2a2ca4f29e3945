"""Readers for the corpus layouts.

All readers take explicit schemas (no inference), return lazy DataFrames and
carry an explicit order key where the reference relies on file order
(``_metadata.file_path`` plus a line/record position).
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import py_strip, split_lines
from quarry.session import fix_splits
from quarry.sources import records


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def file_position(*more):
    """Order key of a scanned record: its file, the place of its split in the
    file, 0 (a record within its split), its number in the task. Comparable within one read (the numbers of
    one file ascend in file order), and explicit where order matters."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.lit(0).alias("piece"), F.monotonically_increasing_id().alias("number"), *more)


def scan_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",",
                   header: bool = True, position: str | None = None, multi_line: bool = True) -> DataFrame:
    """Delimited text with ``"`` quoting, doubled-quote escape and
    multi-line fields, every column STRING, empty fields as ''. ``position``
    names a column with the record's place in its file.

    Large files split: which line breaks stand inside quotes is settled over
    the splits by ``records.scan_records`` (one scan when called), and the
    records are parsed by Spark. With ``multi_line=False`` (no line breaks
    inside fields) Spark's own reader splits them.

    ``header=True`` drops the first record of each file (the reference's
    ``load_header=False``; its flag name reads backwards, D14)."""
    schema = string_schema(columns)
    if not multi_line:
        df = (spark.read.schema(schema).option("sep", sep).option("quote", '"').option("escape", '"')
              .option("header", str(header).lower()).option("mode", "FAILFAST").csv(path))
        df = df.select("*", file_position().alias(position)) if position else df
        return df.na.fill("", list(columns))
    found = records.scan_records(spark, path, sep).where(F.length("record") > 0)
    if header:
        found = found.where(~F.col("first"))
    fields = F.from_csv("record", schema.simpleString()[len("struct<"):-1].replace(":", " "),
                        {"sep": sep, "quote": '"', "escape": '"', "mode": "FAILFAST"})
    if position:
        found = found.join(F.broadcast(records.file_names(spark, path)), "file", "left")
        named = F.coalesce("path", F.raise_error(F.lit("a file that was read is not among the files listed")))
        place = F.struct(named.alias("file"), "block", "piece", "number").alias(position)
        return found.select(fields.alias("_q"), place).select("_q.*", position).na.fill("", list(columns))
    return found.select(fields.alias("_q")).select("_q.*").na.fill("", list(columns))


def scan_lines(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """One row per line (``value``) by Python's line boundaries; the file
    itself is split at ``\\n`` only. ``position`` names an order column."""
    raw = spark.read.option("lineSep", "\n").text(path)
    # "\r\n" is one boundary, so a last "\r" belongs to the line end
    lines = raw.select(file_position().alias("_q_at"),
                       F.posexplode(split_lines(F.regexp_replace("value", "\r$", ""))).alias("_q_n", "value"))
    if position is None:
        return lines.select("value")
    return lines.select("value", F.struct("_q_at", "_q_n").alias(position))


def scan_json_objects(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object per file, with the file path kept."""
    df = spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    return df.withColumn("file_path", F.col("_metadata.file_path"))


# Schemas of the article tree
ARTICLE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("meta_data", T.StructType([T.StructField("description", T.StringType())]))])
POST_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("entities", T.StructType([T.StructField("urls", T.ArrayType(
        T.StructType([T.StructField("expanded_url", T.StringType())])))]))])


PATH_KEYS = ["dataset", "news_label", "news_id"]


def _with_strings(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(n, T.StringType()) for n in names])


def scan_article_tree(spark: SparkSession, root: str, datasets: Sequence[str] = ("politifact",),
                      layout: str = "tree") -> tuple[DataFrame, DataFrame]:
    """Articles and their posts -> (articles, posts).

    ``layout="tree"``: the raw corpus, ``{dataset}/{fake,real}/{news_id}/news
    content.json`` (one object per file) and ``.../tweets/*``.
    ``layout="partitioned"``: the same tables written by Spark as JSON lines
    under ``root/articles`` and ``root/posts`` partitioned by
    ``dataset/news_label`` (partition pruning on the label side), the news id a
    field of the records; ``/news_id`` as a third folder works the same way, with
    a file or more for each article. What is a folder comes from the path. Articles without a
    content file never appear; all posts do (the url counts A01/A02 need no
    content file), and the join with articles (J02) leaves such posts out."""
    if layout == "partitioned":
        arts = spark.read.schema(_with_strings(ARTICLE_SCHEMA, PATH_KEYS)).option("mode", "FAILFAST").json(f"{root}/articles")
        posts = spark.read.schema(_with_strings(POST_SCHEMA, PATH_KEYS)).option("mode", "FAILFAST").json(f"{root}/posts")
        arts = arts.filter(F.col("dataset").isin(list(datasets)))
        posts = posts.select("dataset", "news_label", "news_id", F.col("id").alias("post_id"),
                             "text", F.col("entities.urls").alias("urls"))
    else:
        ds = "{" + ",".join(datasets) + "}"
        path_re = r"/([^/]+)/(fake|real)/([^/]+)/"
        arts = (spark.read.schema(ARTICLE_SCHEMA).option("multiLine", "true").option("mode", "FAILFAST")
                .json(f"{root}/{ds}/*/*/news content.json"))
        arts = arts.select("*", *[F.regexp_extract("_metadata.file_path", path_re, i).alias(c)
                                  for i, c in ((1, "dataset"), (2, "news_label"), (3, "news_id"))])
        posts = (spark.read.schema(POST_SCHEMA).option("multiLine", "true").option("mode", "FAILFAST")
                 .json(f"{root}/{ds}/*/*/tweets/*"))
        posts = posts.select(
            *[F.regexp_extract("_metadata.file_path", path_re, i).alias(c)
              for i, c in ((1, "dataset"), (2, "news_label"), (3, "news_id"))],
            F.col("id").alias("post_id"), F.col("text"), F.col("entities.urls").alias("urls"))
    arts = arts.select("dataset", "news_label", "news_id", F.col("url"),
                       F.coalesce(F.col("title"), F.lit("")).alias("title"),
                       F.coalesce(F.col("meta_data.description"), F.lit("")).alias("description"))
    return arts, posts


THREAD_POST_SCHEMA = T.StructType([T.StructField("id", T.LongType()),
                                   T.StructField("text", T.StringType())])


def scan_thread_tree(spark: SparkSession, root: str, with_topic: bool = True,
                     layout: str = "tree") -> DataFrame:
    """Thread posts -> (thread, post, text, is_source) with raw text;
    callers clean it (C01) and drop blanks. Source text wins over reply text
    on the same id (``keep_source_text``).

    ``layout="tree"``: ``[topic/]discourse/{replies,source-tweet}/*`` files,
    one object each. ``layout="partitioned"``: JSON lines written by Spark
    under ``root`` partitioned by ``folder`` (and optionally ``thread``; a
    ``thread`` field in the records works the same way)."""
    if layout == "partitioned":
        df = spark.read.schema(_with_strings(THREAD_POST_SCHEMA, ["thread", "folder"])).option("mode", "FAILFAST").json(root)
        return df.select("thread", F.col("id").cast("string").alias("post"), "text",
                         (F.col("folder") == "source-tweet").alias("is_source"))
    pattern = f"{root}/*/*" if with_topic else f"{root}/*"
    df = (spark.read.schema(THREAD_POST_SCHEMA).option("multiLine", "true").option("mode", "FAILFAST")
          .json(f"{pattern}/{{replies,source-tweet}}/*"))
    folder_re = r"/([^/]+)/(replies|source-tweet)/[^/]+$"
    return df.select(
        F.regexp_extract("_metadata.file_path", folder_re, 1).alias("thread"),
        F.col("id").cast("string").alias("post"), F.col("text"),
        (F.regexp_extract("_metadata.file_path", folder_re, 2) == "source-tweet").alias("is_source"))


def keep_source_text(posts: DataFrame, keys=("thread", "post")) -> DataFrame:
    """``{**replies, **sources}``: per id, the source post's text wins."""
    from quarry.operators.indexing import keep_one_per_key
    ordered = posts.withColumn("_q_src", F.col("is_source").cast("int"))
    return keep_one_per_key(ordered, list(keys), "_q_src", keep="last").drop("_q_src")


def scan_label_maps(json_text: DataFrame, text_col: str = "value",
                    nested_key: str | None = None) -> DataFrame:
    """JSON label maps (post id -> label) to rows (post, label).

    ``nested_key`` reads the 2019 layout (maps under ``subtaskaenglish``).
    Other columns of ``json_text`` (e.g. thread, priority) are kept."""
    src = F.col(text_col)
    if nested_key:
        src = F.get_json_object(src, f"$.{nested_key}")
    parsed = F.from_json(src, "map<string,string>", {"mode": "FAILFAST"})
    others = [c for c in json_text.columns if c != text_col]
    return json_text.select(*others, F.explode(parsed).alias("post", "label"))


def scan_headlines(df: DataFrame, order_col: str) -> DataFrame:
    """Headline table (url_id, full_url, headline, media, clean): keep
    ``clean == '1'``, last row per url_id wins (a header row falls out since
    its clean field reads ``clean``)."""
    from quarry.operators.indexing import keep_one_per_key
    kept = df.filter(F.col("clean") == "1")
    return keep_one_per_key(kept, ["url_id"], order_col, keep="last")


MANIFEST_COLUMNS = ["url_id", "short_url", "full_url"]


def scan_url_manifest(spark: SparkSession, path: str, thread_pattern: str = r"/([^/]+)/urls\.dat$",
                      layout: str = "tree") -> DataFrame:
    """URL manifests (tab, no header) -> (thread, url_id, short_url, full_url).

    ``layout="tree"``: the raw corpus, a ``urls.dat`` per thread; the thread id
    comes from the file path. ``layout="table"``: the same rows written by Spark,
    any number of threads in a file, the thread id the first field."""
    fields = MANIFEST_COLUMNS if layout == "tree" else ["thread", *MANIFEST_COLUMNS]
    df = (spark.read.schema(string_schema(fields)).option("sep", "\t")
          .option("quote", '"').option("escape", '"').option("header", "false")
          .option("mode", "FAILFAST").csv(path))
    if layout == "tree":
        df = df.select(F.regexp_extract(F.col("_metadata.file_path"), thread_pattern, 1).alias("thread"), *MANIFEST_COLUMNS)
    return df.na.fill("", MANIFEST_COLUMNS)


_JSON_TOKEN = re.compile(r'\s*("(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s{}\[\],:"]+)')


def reply_edges_of(text: str) -> list[tuple[str, str]]:
    """(parent, node) pairs of one nested reply JSON, in one scan with an
    explicit stack, so nesting depth does not matter. A key's parent is the
    key whose object holds it; what lists hold is no reply. Text that is not
    one JSON value raises."""
    out: list[tuple[str, str]] = []
    # a frame per open bracket: [kind, key it stands under, key being read, what may come next]
    stack: list[list] = []
    expect, at, end = "value", 0, len(text.rstrip())
    while at < end:
        m = _JSON_TOKEN.match(text, at)
        if m is None or (expect == "end"):
            raise ValueError(f"reply structure is not JSON at {at}: {text[at:at + 40]!r}")
        token, at = m[1], m.end()
        top = stack[-1] if stack else None
        if expect in ("key", "key or }") and token[0] == '"':
            top[2] = json.loads(token)
            if top[1] is not None and top[3]:
                out.append((top[1], top[2]))
            expect = ":"
        elif expect == ":" and token == ":":
            expect = "value"
        elif expect in ("value", "value or ]") and token in "{[":
            in_tree = (top is None or (top[0] == "{" and top[3])) and token == "{"
            stack.append([token, top[2] if top else None, None, in_tree])
            expect = "key or }" if token == "{" else "value or ]"
        elif (token == "}" and expect in ("key or }", ", or }")) or (token == "]" and expect in ("value or ]", ", or ]")):
            stack.pop()
            expect = "end" if not stack else ", or }" if stack[-1][0] == "{" else ", or ]"
        elif token == "," and expect in (", or }", ", or ]"):
            expect = "key" if top[0] == "{" else "value"
        elif expect in ("value", "value or ]") and token not in "}],:":
            json.loads(token)
            expect = "end" if top is None else ", or }" if top[0] == "{" else ", or ]"
        else:
            raise ValueError(f"reply structure is not JSON at {at}: {token!r}, expected {expect}")
    if expect != "end":
        raise ValueError("reply structure ends early")
    return out


def scan_reply_edges(structures: DataFrame, json_col: str = "structure",
                     thread_col: str = "thread") -> DataFrame:
    """Nested reply JSON -> (thread, parent, node) edges, one pass over
    each text in Arrow batches; null text has no edges, broken text fails."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            thread, text = (batch.column(i).to_pylist() for i in (0, 1))
            rows = [(t, p, n) for t, s in zip(thread, text, strict=True) if s is not None for p, n in reply_edges_of(s)]
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], type=batch.column(0).type), pa.array(cols[1], type=pa.string()),
                                              pa.array(cols[2], type=pa.string())], names=["thread", "parent", "node"])
    given = structures.select(F.col(thread_col).alias("thread"), F.col(json_col).alias("_q_json"))
    kind = given.schema["thread"].dataType.simpleString()
    return given.mapInArrow(run, f"thread {kind}, parent string, node string")


def scan_stance_corpus(spark: SparkSession, bodies_path: str,
                       stances_path: str) -> tuple[DataFrame, DataFrame]:
    """Bodies CSV (body id, body) and stances CSV (headline, body id,
    stance), header rows dropped, columns by position; ``position`` is the
    record's place in its file, for the steps that depend on file order."""
    bodies = scan_delimited(spark, bodies_path, ["body_id", "body"], sep=",", header=True, position="position")
    stances = scan_delimited(spark, stances_path, ["headline", "body_id", "stance"], sep=",",
                             header=True, position="position")
    return bodies, stances


def scan_annotation_batches(spark: SparkSession, root: str, fmt: str = "parquet",
                            columns: Sequence[str] | None = None) -> DataFrame:
    """Annotation batches stored as ``root/batch=*/news_label=*/``; the
    partition columns come from the directory names (partition pruning) as they
    are written there: a batch named ``01`` stays ``01``. CSV columns are strings,
    named by ``columns`` or by the files' header."""
    reader = spark.read.option("basePath", root)
    if fmt == "csv":
        reader = (reader.option("header", "true").option("multiLine", "true").option("quote", '"').option("escape", '"')
                  .option("mode", "FAILFAST"))
    found = reader.format(fmt).load(root).schema
    folders = [f.name for f in found if f.name in ("batch", "news_label")]
    fields = list(string_schema(columns)) if columns else [f for f in found if f.name not in folders]
    return reader.schema(T.StructType([*fields, *string_schema(folders)])).format(fmt).load(root)


def scan_event_lines(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """``eid:<id>\\tlabel:<l>\\t<id id ...>`` -> (event_id, label, post_ids)."""
    parts = F.split(F.col(text_col), "\t")
    return lines.select(
        F.regexp_replace(F.element_at(parts, 1), "eid:", "").alias("event_id"),
        F.element_at(parts, 2).alias("label"),
        F.split(F.element_at(parts, 3), " ").alias("post_ids"))


def scan_sentence_pairs(lines: DataFrame, text_col: str = "value",
                        strict: bool = True) -> DataFrame:
    """``label\\tid1\\tid2\\ts1\\ts2`` lines, outer whitespace stripped,
    exactly five fields (the job fails otherwise when ``strict``)."""
    fields = F.split(py_strip(F.col(text_col)), "\t")
    parsed = lines.select(fields.alias("_q_f"))
    if strict:
        parsed = parsed.withColumn("_q_f", F.when(F.size("_q_f") == 5, F.col("_q_f")).otherwise(
            F.raise_error(F.lit("sentence pair line does not have 5 fields"))))
    else:
        parsed = parsed.filter(F.size("_q_f") == 5)
    names = ["label", "id1", "id2", "s1", "s2"]
    return parsed.select(*[F.element_at("_q_f", i + 1).alias(n) for i, n in enumerate(names)])


def read_sentence_pairs(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """S13 on files: the first line of each file is a header and is left out. What
    tells these lines, a row per file, is found by one scan when called (a broadcast
    would have to be there within its timeout) and goes to the lines, which stay where they are."""
    fix_splits(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select("value", file_position().alias("_q_at"))
    # a file's first line is the first of its first split
    found = lines.filter(F.col("_q_at.block") == 0).groupBy(F.col("_q_at.file").alias("_q_file")).agg(F.min("_q_at.number").alias("_q_number"))
    first = spark.createDataFrame(found.collect(), found.schema)
    body = lines.join(F.broadcast(first), (F.col("_q_at.file") == F.col("_q_file")) & (F.col("_q_at.block") == 0)
                      & (F.col("_q_at.number") == F.col("_q_number")), "left_anti")
    return scan_sentence_pairs(body, "value", strict)


def scan_logits(json_text: DataFrame, text_col: str = "value", pos_out: str = "idx") -> DataFrame:
    """A JSON array of logit rows -> one row per element, ``pos_out`` =
    position in the document (the example id), other columns kept."""
    arr = F.from_json(F.col(text_col), "array<array<double>>", {"mode": "FAILFAST"})
    others = [c for c in json_text.columns if c != text_col]
    return json_text.select(*others, F.posexplode(arr).alias(pos_out, "logits")).withColumn(
        pos_out, F.col(pos_out).cast("bigint"))


_LOGIT = r"-?(?:[0-9]+(?:\.[0-9]*)?(?:[eE][+-]?[0-9]+)?)"


def read_logits_file(spark: SparkSession, path: str, pos_out: str = "idx", file_out: str | None = None) -> DataFrame:
    """S14 on files: one JSON document (an array of logit rows) per model, read
    by many tasks -> (idx, logits); ``file_out`` names a column with the file.

    A closing bracket ends a row, so the file is cut there, wherever its splits
    fall, and every piece is one row: the brackets of the document itself open
    the first piece and leave an empty one behind the last row. Rows are numbered
    where they stand (``number_in_place``), from 0 in each file. What is no row
    of numbers fails."""
    from quarry.operators.indexing import number_in_place
    pieces = spark.read.option("lineSep", "]").text(path).select("value", file_position().alias("_q_at"))
    begins = (F.col("_q_at.block") == 0) & F.col("value").rlike(r"^\s*\[\s*\[")
    row = rf"^\s*(?:\[\s*|,\s*)\[\s*({_LOGIT}(?:\s*,\s*{_LOGIT})*)\s*$"
    kept = pieces.filter(~F.col("value").rlike(r"^\s*\[?\s*$"))  # ends of documents, empty documents
    numbers = F.regexp_extract("value", row, 1)
    wrong = (numbers == "") | (F.col("value").rlike(r"^\s*\[") & ~begins)
    numbers = F.when(wrong, F.raise_error(F.concat(F.lit("not a row of logits: "), F.substring("value", 1, 80)))).otherwise(numbers)
    rows = number_in_place(kept, "_q_at", out="_q_all").select(
        F.col("_q_at.file").alias("file"), "_q_all", F.transform(F.split(numbers, ","), lambda x: F.trim(x).cast("double")).alias("logits"))
    first = number_in_place(kept, "_q_at", out="_q_all").groupBy(F.col("_q_at.file").alias("file")).agg(F.min("_q_all").alias("_q_first"))
    file = [F.col("file").alias(file_out)] if file_out else []
    return rows.join(first, "file").select(*file, (F.col("_q_all") - F.col("_q_first")).alias(pos_out), "logits")


def scan_folds(spark: SparkSession, path: str, fold: int | None = None, split: str | None = None) -> DataFrame:
    """The sets that ``sinks.write_fold_table`` wrote: (fold, split, columns), of
    all sets or of the wanted fold and split; only the folders of the wanted
    sets are read, each once, and a row is repeated per set while it is read."""
    kind = "fold bigint, split string, folds array<bigint>, columns array<string>, sep string, header boolean"
    sets = [r for r in spark.read.schema(kind).json(f"{path}/sets").collect()  # two rows per fold
            if fold in (None, r["fold"]) and split in (None, r["split"])]
    if not sets:
        raise ValueError(f"no set of fold {fold}, split {split} in {path}")
    needed = sorted({g for r in sets for g in r["folds"]})
    rows = scan_delimited(spark, f"{path}/fold={{{','.join(map(str, needed))}}}", sets[0]["columns"], sets[0]["sep"],
                          sets[0]["header"], position="_q_at")
    own = F.regexp_extract("_q_at.file", r"/fold=([0-9]+)/", 1).cast("bigint")
    member = F.filter(F.array(*[F.struct(F.lit(r["fold"]).cast("bigint").alias("fold"), F.lit(r["split"]).alias("split"),
                                         F.array(*[F.lit(g).cast("bigint") for g in r["folds"]]).alias("folds")) for r in sets]),
                      lambda s: F.array_contains(s["folds"], own))
    return rows.withColumn("_q_set", F.explode(member)).select("_q_set.fold", "_q_set.split", *sets[0]["columns"])


# the scan's helper travels to the workers inside the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])
