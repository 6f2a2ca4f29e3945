"""SimHash near-dedup by multi-index hashing (operator 7).

Each text gets one 64-bit fingerprint from its word shingles (Arrow batches,
whole texts). Everything after works on distinct fingerprints, so copies cost
one row however many there are:

1. A fingerprint is cut into m segments. Two fingerprints within ``max_bits``
   differing bits agree in some segment i up to r_i bits when the sum of
   (r_i + 1) is max_bits + 1. The table holds every fingerprint once per
   segment; the query side enumerates the Hamming ball of radius r_i around
   each segment, fetches the matches by an equi-join and verifies the distance
   over all 64 bits. m follows the number of fingerprints (a segment of about
   log2 n bits keeps buckets short); the links found are the same for every m.
2. A fingerprint one of whose probes meets more than ``bucket_rows`` rows takes
   an exact other way: it is linked through the points of its own ball of
   radius max_bits / 2. Two fingerprints link exactly if these balls meet, so
   all that share a point are joined to the smallest there. That costs a fixed
   number of rows each instead of the square of the bucket.
3. Links become components by rounds that join every vertex to its smallest
   neighbour and contract the edges, checkpointed in the shared folder.

Defined cases: null, empty and wordless texts have fingerprint 0, which links
like any other; repeated rows are copies of each other; null doc_ids take part,
and a component without any doc_id has a null component_id; an empty table gives
an empty result; other columns are ignored (``keep_one_per_component`` returns
them all).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import append_columns, saved, ship_by_value, text_col

SHINGLE_WORDS, MAX_BITS = 4, 4
#: Rows of one bucket beyond which a fingerprint is linked through ball points.
BUCKET_ROWS = 4000


def _fingerprint(text: bytes, words: int) -> int:
    from itertools import accumulate

    import numpy as np
    import xxhash
    found = text.lower().split()  # bytes: only A-Z, only the six ASCII spaces
    if not found:
        return 0
    line, h64 = b" ".join(found), xxhash.xxh64_intdigest
    ends = list(accumulate(map(len, found), lambda a, n: a + n + 1))
    if len(found) <= words:
        h = [h64(line, 42)]
    else:
        h = [h64(line[a:e], 42) for a, e in zip([0, *(e + 1 for e in ends)], ends[words - 1:], strict=False)]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 14):
        part = np.array(h[at:at + (1 << 14)], dtype=np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS, out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a bigint."""
    def kernel(column):
        import numpy as np
        return [np.array([_fingerprint((t or "").encode(), words) for t in column.to_pylist()], dtype=np.int64)]
    return append_columns(docs, text, [(out, "bigint")], kernel)


def segments_for(n: int) -> int:
    """Segments of about log2 n bits, from 2 to 4 of them."""
    return min(4, max(2, 64 // max(16, n.bit_length() + 3)))


def _layout(m: int, max_bits: int) -> list[tuple[int, int, int]]:
    """(shift, bits, radius) of each segment."""
    m = min(m, max_bits + 1)
    spare = max_bits + 1 - m
    out, shift = [], 0
    for i in range(m):
        bits = 64 // m + (i < 64 % m)
        out.append((shift, bits, spare // m + (i < spare % m)))
        shift += bits
    return out


def _ball(bits: int, radius: int) -> list[int]:
    return [sum(1 << j for j in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _array(values: list[int]):
    return F.array(*(F.lit(_signed(v)).cast("bigint") for v in values))


def links(distinct: DataFrame, n: int, max_bits: int = MAX_BITS, segments: int | None = None,
          bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) of distinct fingerprints ``fp`` whose closure is that of all
    pairs within ``max_bits``: every pair unless both ends are crowded."""
    layout = _layout(segments or segments_for(n), max_bits)

    def segment(shift, bits):
        return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << bits) - 1))
    table = distinct.select("fp", F.explode(F.array(*(
        F.struct(F.lit(i).alias("seg"), segment(s, w).alias("key")) for i, (s, w, _) in enumerate(layout)))).alias("s")
    ).select("fp", "s.seg", "s.key")
    def ball(no, shift, bits, radius):
        return F.transform(_array(_ball(bits, radius)), lambda e: F.struct(
            F.lit(no).alias("seg"), segment(shift, bits).bitwiseXOR(e).alias("key")))
    probe_keys = F.concat(*(ball(i, *part) for i, part in enumerate(layout)))
    probes = distinct.select("fp", F.explode(probe_keys).alias("s")).select("fp", "s.seg", "s.key")
    crowded = table.groupBy("seg", "key").count().where(F.col("count") > bucket_rows).drop("count")
    crowded_fp = None
    if crowded.limit(1).count():
        crowded_fp = saved(probes.join(crowded, ["seg", "key"], "left_semi").select("fp").distinct())
        probes = probes.join(crowded_fp, "fp", "left_anti")
    found = (probes.withColumnRenamed("fp", "a").join(table.withColumnRenamed("fp", "b"), ["seg", "key"])
             .where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)))
    if crowded_fp is None:
        found = found.where(F.col("a") < F.col("b"))
    found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    if crowded_fp is not None:
        # balls of radius floor(max_bits/2) and the rest meet exactly within max_bits
        near, far = _ball(64, max_bits // 2), _ball(64, max_bits - max_bits // 2)
        star = crowded_fp.select("fp", F.explode(F.transform(_array(near), lambda e: F.col("fp").bitwiseXOR(e))).alias("p"))
        if len(far) != len(near):
            raise ValueError("an odd max_bits needs wider balls: give bucket_rows a larger value")
        least = star.groupBy("p").agg(F.min("fp").alias("b"))
        found = found.union(star.join(least, "p").where(F.col("fp") != F.col("b"))
                            .select(F.least("fp", "b"), F.greatest("fp", "b")))
    return found.distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component.

    Each round follows every vertex' smallest neighbours down to a local minimum,
    renames the edges' ends and drops those whose ends became one. Only local
    minima are left, so vertices at least halve, and a crowded group folds up in
    the first round instead of being carried through all."""
    edges = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    maps = []
    while edges.limit(1).count():
        ends = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(
            edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
        step = saved(ends.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("to")))
        moving = True
        while moving:  # follow the smallest neighbours down to the local minimum, four steps a job
            second = step.join(step.select(F.col("v").alias("to"), F.col("to").alias("two")), "to").select("v", "to", "two")
            step = saved(second.join(second.select(F.col("v").alias("two"), F.col("two").alias("four")), "two")
                         .select("v", F.col("four").alias("to"), (F.col("four") < F.col("to")).alias("moved")))
            moving = step.where("moved").limit(1).count() > 0
            step = step.select("v", "to")
        maps.append(step)
        edges = saved(edges.join(step.select(F.col("v").alias("a"), F.col("to").alias("x")), "a")
                      .join(step.select(F.col("v").alias("b"), F.col("to").alias("y")), "b")
                      .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a <> b").distinct())
    if not maps:
        return nodes.select("node", F.col("node").alias("root"))
    root = maps.pop()
    while maps:  # where a vertex went, and where that one went later
        later = root.select(F.col("v").alias("to"), F.col("to").alias("root"))
        root = maps.pop().join(later, "to", "left").select("v", F.coalesce("root", "to").alias("to"))
    return nodes.join(root.select(F.col("v").alias("node"), F.col("to").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    segments: int | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, text_key (a hash of the text), fp and component_id of every row."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_col(docs).alias("text"))
    marked = saved(fingerprints(narrow, words=words).select("doc_id", F.xxhash64("text").alias("text_key"), "fp"))
    distinct = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    n = distinct.count()
    edges = links(distinct, n, max_bits, segments, bucket_rows)
    root = components(distinct.select(F.col("fp").alias("node")), edges).withColumnRenamed("node", "fp")
    with_first = saved(distinct.join(root, "fp"))
    smallest = with_first.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = with_first.select("fp", "root").join(smallest, "root")
    return marked.join(classes, "fp").select("doc_id", "text_key", "fp", "component_id", "root")


def keep_one_per_component(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near-duplicates: the row with the smallest doc_id (nulls
    last, then the smaller text hash) of each component stays."""
    found = near_duplicates(docs, **options)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    best = found.groupBy("root").agg(F.min(order).alias("best"))
    same = found.groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("__llm_rows"))
    winners = saved(best.join(same, (best["root"] == same["root"])
                              & same["doc_id"].eqNullSafe(F.col("best.doc_id"))
                              & (same["text_key"] == F.col("best.text_key")))
                    .select(F.col("best.doc_id").alias("__llm_doc"), F.col("best.text_key").alias("__llm_key"), "__llm_rows"))
    kept = docs.join(winners, docs["doc_id"].cast("bigint").eqNullSafe(F.col("__llm_doc"))
                     & (F.xxhash64(text_col(docs)) == F.col("__llm_key")))
    single = kept.where(F.col("__llm_rows") == 1).select(*docs.columns)
    repeated = kept.where(F.col("__llm_rows") > 1)
    if not winners.where(F.col("__llm_rows") > 1).limit(1).count():
        return single
    one = repeated.dropDuplicates(["__llm_doc", "__llm_key"]).select(*docs.columns)
    return single.unionByName(one)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = near_duplicates(docs, words=SHINGLE_WORDS, max_bits=MAX_BITS)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


ship_by_value(__name__)
