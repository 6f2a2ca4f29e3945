"""Importance resampling toward a target distribution (operator 12).

Features are runs of 1 to ``grams`` consecutive words, hashed into buckets. How
much more frequent a bucket is in the target texts than in the corpus is its
gain; a text's weight is the sum of its features' gains, and a seeded Gumbel
number on top of it makes the highest scores a sample without replacement.

Line breaks separate words, so a text is cut into lines and equal lines are
counted once for the whole corpus (a partial count in each task first):

1. Each distinct line's words are hashed once, into a short string of bucket
   numbers kept beside its number of occurrences; the corpus counts are sums of
   buckets times occurrences. Runs of words that cross a line's end are hashed
   from the texts and added (there are none for ``grams`` = 1).
2. The gains follow from two lists of ``buckets`` numbers. Each distinct line's
   gain is summed once more, from its bucket numbers.
3. A narrow table holds (row, line digest) for every line of every text; the
   lines' gains are joined to it and summed per row. Lines that make up a
   ``FREQUENT``-th of all lines or more - at most so many - are broadcast, so
   that a line which stands everywhere is no shuffle key.
4. Rows of at least ``least_words`` words are ranked by score with the global
   index (range shuffle of narrow rows); the first ``percent`` per cent are drawn.

Lines are matched by two 64-bit hashes. Defined cases: null and empty texts have
no features, weight 0, and are never drawn; an empty target gives every bucket
the same numerator; a null doc_id is hashed as an empty one and comes last among
equal scores; repeated rows are ranked each, in any order among rows equal in
score and doc_id; other columns are kept, but for the text and those named as an
output; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import _bytes as b
from quarry.llm._shared import bound_arrow_batches, ship_by_value, stored, text_col, worker_cache
from quarry.llm.decontamination import _words, words_of
from quarry.operators.indexing import global_index

BUCKETS, GRAMS, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, "2024"
#: A line is frequent from this share of all lines on, which bounds their number.
FREQUENT = 2_000
#: Bytes of words whose checksums a worker keeps.
CACHE_BYTES = 16 << 20
#: A character that belongs to a word.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
OUTPUTS = ["n_words", "n_features", "weight", "score", "rank"]


# -- kernels ----------------------------------------------------------------------------------

def _checksums(words: list[bytes]) -> np.ndarray:
    """crc32 of each word; a worker keeps those of short ones up to a number of bytes."""
    import zlib
    kept = worker_cache().setdefault("word crc32", {"size": 0, "of": {}})
    known, out = kept["of"], np.empty(len(words), np.int64)
    for i, word in enumerate(words):
        found = known.get(word)
        if found is None:
            found = zlib.crc32(word)
            if len(word) <= 64:
                kept["size"] += len(word) + 100
                if kept["size"] > CACHE_BYTES:
                    known.clear()
                    kept["size"] = len(word) + 100
                known[word] = found
        out[i] = found
    return out


def run_checksums(data: np.ndarray, start, end, hashed, grams: int):
    """For k = 1 .. ``grams``: crc32 of the k words from each word on, joined by
    one space (an entry too near the end of the array is missing)."""
    import zlib
    _, at, word = np.unique(hashed, return_index=True, return_inverse=True)
    raw = data.tobytes()
    spelled = [raw[s:e] for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True)]
    crc, run = _checksums(spelled), word
    yield crc[word]
    for k in range(2, grams + 1):
        if len(word) < k:
            return
        # distinct pairs of a shorter run and the word behind it
        pair = run[:len(word) - k + 1] * len(spelled) + word[k - 1:]
        _, first, next_run = np.unique(pair, return_index=True, return_inverse=True)
        crc = np.array([zlib.crc32(b" " + spelled[w], c) for w, c in zip(word[first + k - 1].tolist(), crc[run[first]].tolist(), strict=True)], np.int64)
        run = next_run
        yield crc[run]


def run_buckets(data, start, end, hashed, part: np.ndarray, whole: np.ndarray | None, grams: int, buckets: int):
    """(part, bucket) of each run of words within one part, sorted by part; with
    ``whole`` those within one whole that cross the parts of it, by whole."""
    owners, found = [], []
    for k, crc in enumerate(run_checksums(data, start, end, hashed, grams)):
        last = part[k:]
        own = (part[:len(last)] == last) if whole is None else (part[:len(last)] != last) & (whole[:len(last)] == whole[k:])
        owners.append((part if whole is None else whole)[:len(last)][own])
        found.append(crc[own] % buckets)
    owner, bucket = np.concatenate(owners or [np.zeros(0, np.int64)]), np.concatenate(found or [np.zeros(0, np.int64)])
    if grams > 1:
        by = np.argsort(owner, kind="stable")
        owner, bucket = owner[by], bucket[by]
    return owner, bucket


def _as_binary(owner: np.ndarray, bucket: np.ndarray, n: int):
    """Bucket numbers of each of ``n`` owners as an Arrow array of 32-bit strings of bytes."""
    import pyarrow as pa
    ends = np.searchsorted(owner, np.arange(n + 1)) * 4
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.astype(np.int64).tobytes()),
                                                        pa.py_buffer(bucket.astype("<u4").tobytes())]).cast(pa.binary())


def _from_binary(column) -> tuple[np.ndarray, np.ndarray]:
    """(all bucket numbers, first of each row and one more)."""
    import pyarrow as pa
    import pyarrow.compute as pc
    column = pc.cast(column, pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return values.copy().view("<u4"), (offsets - offsets[0]) // 4


# -- the job ----------------------------------------------------------------------------------

def _digests(line):
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(7), line).alias("k2")]


def distinct_lines(texts: DataFrame, text: str, grams: int, buckets: int) -> DataFrame:
    """(k1, k2, n, words, buckets) of the distinct lines that have a word: n
    occurrences, bucket numbers of the runs of words within the line."""
    bound_arrow_batches(texts.sparkSession)
    lines = texts.select(F.explode(F.split(F.col(f"`{text}`"), "\n", -1)).alias("line")).where(F.col("line").rlike(WORD))
    counted = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))

    def features(batches):
        import pyarrow as pa
        for batch in batches:
            data, start, end, hashed, first = words_of(batch.column(3))
            n = np.diff(first)
            owner, bucket = run_buckets(data, start, end, hashed, np.repeat(np.arange(len(n)), n), None, grams, buckets)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n), _as_binary(owner, bucket, len(n))],
                                             names=["k1", "k2", "n", "words", "buckets"])
    return stored(counted.select(*_digests("line"), "n", "line").mapInArrow(
        features, "k1 bigint, k2 bigint, n bigint, words bigint, buckets binary"))


def crossing_runs(texts: DataFrame, text: str, row: str, grams: int, buckets: int) -> DataFrame:
    """(row, n = 1, buckets) of the texts with runs of words that cross a line's end."""
    bound_arrow_batches(texts.sparkSession)

    def features(batches):
        import pyarrow as pa
        for batch in batches:
            raw, offsets = b.text_bytes(batch.column(1))
            for lo, hi in b.chunks(offsets):
                part = raw[offsets[lo]:offsets[hi]].copy()
                own = offsets[lo:hi + 1] - offsets[lo]
                part[(part >= 65) & (part <= 90)] += 32
                data, start, end, hashed, first = _words(part, own)
                whole = np.repeat(np.arange(hi - lo), np.diff(first))
                line = np.cumsum(data == 10)[start] if len(start) else start
                owner, bucket = run_buckets(data, start, end, hashed, line, whole, grams, buckets)
                some = np.unique(owner)
                made = _as_binary(np.searchsorted(some, owner), bucket, len(some))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(lo + some)), pa.array(np.ones(len(some), np.int64)), made],
                                                 names=["row", "n", "buckets"])
    return stored(texts.select(F.col(row).alias("row"), F.col(f"`{text}`").alias("text")).mapInArrow(
        features, "row bigint, n bigint, buckets binary"))


def bucket_counts(parts: list[DataFrame], buckets: int) -> np.ndarray:
    """Features in each bucket over tables (n, buckets): every task adds up its
    own, Spark the tasks'; ``buckets`` numbers at most come to the driver."""
    def add(batches):
        import pyarrow as pa
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            found, first = _from_binary(batch.column(1))
            times = np.repeat(batch.column(0).to_numpy(), np.diff(first))
            np.add.at(total, found, times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])
    out = np.zeros(buckets, np.int64)
    for part in parts:
        sums = part.select("n", "buckets").mapInArrow(add, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
        for r in sums.collect():
            out[r["bucket"]] += r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) for each bucket."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(s_all + buckets) / (float(s + 1) * float(t_all + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def _gained(table: DataFrame, keys: list[str], gains: np.ndarray) -> DataFrame:
    """``keys`` (bigint) with w and f: gain and number of the features of each row."""
    shared = table.sparkSession.sparkContext.broadcast(gains)  # one number per bucket

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            found, first = _from_binary(batch.column(len(keys)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], pa.array(b.sums(shared.value[found], first)), pa.array(np.diff(first))],
                                             names=[*keys, "w", "f"])
    return table.select(*keys, "buckets").mapInArrow(run, ", ".join(f"{k} bigint" for k in [*keys, "w", "f"]))


def resample(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
             percent: int = PERCENT, seed: str = SEED, text: str = "text", target_text: str = "text") -> DataFrame:
    """All rows of ``docs`` without their text, with n_words, n_features, weight,
    score and rank (1, 2, 3, ... of the drawn rows, null for others)."""
    columns = [c for c in docs.columns if c not in OUTPUTS and c != text]
    held = {c: f"c{i}" for i, c in enumerate(columns)}
    base = docs.select(*[F.col(f"`{c}`").alias(h) for c, h in held.items()], text_col(docs, f"`{text}`").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    if grams > 1:
        base = stored(base)  # the row numbers must hold for two passes
    # one row per line that has a word and one (place 0) per document with its columns: written once
    cut = base.select("row", *held.values(), F.posexplode(F.split(F.concat(F.lit("\n"), F.col("text")), "\n", -1)).alias("at", "line"))
    cut = cut.where((F.col("at") == 0) | F.col("line").rlike(WORD))
    lines = stored(cut.select("row", (F.col("at") == 0).alias("head"), *[F.when(F.col("at") == 0, F.col(h)).alias(h) for h in held.values()],
                              *[F.when(F.col("at") > 0, k).alias(n) for k, n in zip(_digests("line"), ("k1", "k2"), strict=True)]))
    known = distinct_lines(base, "text", grams, buckets)
    crossing = crossing_runs(base, "text", "row", grams, buckets) if grams > 1 else None
    wanted = target.select(text_col(target, f"`{target_text}`").alias("text"), F.monotonically_increasing_id().alias("row"))
    wanted = stored(wanted) if grams > 1 else wanted
    aims = [distinct_lines(wanted, "text", grams, buckets)] + ([crossing_runs(wanted, "text", "row", grams, buckets)] if grams > 1 else [])
    gains = bucket_gains(bucket_counts([known] + ([crossing] if grams > 1 else []), buckets), bucket_counts(aims, buckets))

    gained = _gained(known.select("k1", "k2", "n", "words", "buckets"), ["k1", "k2", "n", "words"], gains)
    total = known.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * FREQUENT >= total  # at most FREQUENT lines
    few = F.broadcast(gained.where(often).select("k1", "k2", F.struct("words", "f", "w").alias("hit")))
    narrow = lines.where(~F.col("head")).select("row", "k1", "k2").join(few, ["k1", "k2"], "left")
    rest = (narrow.where(F.col("hit").isNull()).select("row", "k1", "k2")
            .join(gained.where(~often).select("k1", "k2", "words", "f", "w"), ["k1", "k2"]).select("row", "words", "f", "w"))
    heads = lines.where("head").select("row", *held.values())
    parts = narrow.where(F.col("hit").isNotNull()).select("row", "hit.*").unionByName(rest)
    if grams > 1:
        parts = parts.unionByName(_gained(crossing, ["row"], gains).select("row", F.lit(0).cast("bigint").alias("words"), "f", "w"))
    sums = parts.groupBy("row").agg(F.sum("words").alias("n_words"), F.sum("f").alias("n_features"), F.sum("w").alias("weight"))
    joined = heads.join(sums, "row", "left").fillna(0, ["n_words", "n_features", "weight"])
    scored = stored(joined.withColumn("score", F.col("weight") + gumbel(F.col(held["doc_id"]), seed)))
    able = scored.where(F.col("n_words") >= least_words).select("row", "score", F.col(held["doc_id"]).alias("id"))
    ranked = global_index(able, [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")], out="rank", start=1, total_out="of")
    drawn = ranked.where(F.col("rank") <= F.floor(F.col("of") * percent / 100)).select("row", "rank")
    return scored.join(drawn, "row", "left").select(*[F.col(h).alias(c) for c, h in held.items()], *OUTPUTS)


def gumbel(doc_id, seed: str = SEED):
    """Thousandths of a Gumbel number that depends on the id and the seed alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("bigint")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"), "n_features", "weight", "score", "rank")


ORACLE = r"""
WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, (c & 1) * 3988292384)) AS c
    FROM (SELECT unnest(range(0, 256)) AS i))),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
dw AS (SELECT r, unnest(w) AS w FROM d),
bw AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
v AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
y AS (SELECT w, list_transform(range(0, CAST(length(h) // 2 AS BIGINT)),
                               lambda p: 16 * (instr('0123456789ABCDEF', substr(h, 2 * p + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(h, 2 * p + 2, 1)) - 1) AS bytes FROM v),
c AS (SELECT w, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, z: xor(c >> 8, t[(xor(c, z) & 255) + 1])), 4294967295) % 10000 AS b FROM y, tab),
s AS (SELECT b, count(*) AS s FROM dw JOIN c USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM bw JOIN c USING (w) GROUP BY b),
n AS (SELECT (SELECT count(*) FROM dw) AS sn, (SELECT count(*) FROM bw) AS tn),
g AS (SELECT s.b, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(sn + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(tn + 10000 AS DOUBLE)))) AS BIGINT) AS gain
      FROM s LEFT JOIN t ON s.b = t.b, n),
f AS (SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM dw JOIN c USING (w) JOIN g USING (b) GROUP BY r),
h AS (SELECT r, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             list_reduce(list_prepend(0, list_transform(range(1, 9), lambda p: instr('0123456789abcdef', substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), p, 1)) - 1)), lambda x, z: 16 * x + z) AS h
      FROM d LEFT JOIN f USING (r)),
e AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM h),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, count(*) OVER () AS n FROM e WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k.rank <= (10 * n) // 100 THEN k.rank END AS rank FROM e LEFT JOIN k USING (r)
"""

ship_by_value(__name__)
