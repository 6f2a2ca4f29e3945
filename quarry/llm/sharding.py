"""Sharding by a two-pass external shuffle (operator 6).

Pass 1 scatters the records by a seeded hash over so many buckets that one
fits in memory (``bucket_bytes``); pass 2 gathers a bucket, shuffles it with
Spark's ``shuffle`` (Fisher-Yates, seeded) and lays it out. The buckets in
order form one random sequence of all records, and position p of it is slot
p div n of shard p mod n: shard sizes differ by one row at most (law ``rows``),
and a shard draws from all buckets. Positions come from one count per bucket.
Built-in DataFrame functions only.

The hash takes doc_id and text, so copies of one text spread over all buckets.
Rows equal in both would share a bucket; where they take more than an eighth of
one, they are numbered and their number is hashed as well.

Defined cases: null text counts as empty; null doc_ids and repeated rows are
placed like others; with fewer rows than shards some shards stay empty; an
empty table gives an empty result; columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._shared import saved, text_col
from quarry.operators.indexing import group_row_number

SHARDS, SEED = 40, 29
#: Bytes of records in one bucket on average (a task holds one at a time).
BUCKET_BYTES = 8 << 20
#: What a record costs besides its text.
ROW_BYTES = 16
#: Keys up to which the table of repeated rows is broadcast (at most 8 a bucket).
BROADCAST_KEYS = 1 << 20


def salted(drawn: DataFrame, size, bucket_bytes: int) -> DataFrame:
    """``drawn`` with draws of their own for rows that share one and together
    exceed an eighth of a bucket; rows are numbered in the order of their hash,
    and whole copies in any, so the draws are the same for any partitioning."""
    n, taken = F.count(F.lit(1)), F.sum(size)
    heavy = saved(drawn.groupBy("__draw").agg(n.alias("n"), taken.alias("bytes"))
                  .where((F.col("n") > 1) & (F.col("bytes") > bucket_bytes // 8)).select("__draw"))
    many = heavy.count()
    if not many:
        return drawn
    keys = F.broadcast(heavy) if many <= BROADCAST_KEYS else heavy
    row_hash = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in drawn.columns])))
    copies = drawn.join(keys, "__draw").withColumns({"__hash": row_hash, "__tie": F.monotonically_increasing_id()})
    numbered = group_row_number(copies, ["__draw"], ["__hash", "__tie"], out="__copy")
    return drawn.join(keys, "__draw", "left_anti").unionByName(
        numbered.withColumn("__draw", F.xxhash64("__draw", "__copy")).select(*drawn.columns))


def shard(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
          text: str = "text") -> DataFrame:
    """``docs`` with size, law, shard and slot. Two aggregates run here (total
    bytes, repeated rows)."""
    kept = docs.drop(*[c for c in ("size", "law", "shard", "slot") if c in docs.columns])
    size = F.octet_length(text_col(kept, text)).cast("bigint") + ROW_BYTES
    total = kept.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"), text_col(kept, text))
    drawn = salted(kept.withColumn("__draw", draw), size, bucket_bytes)
    bucket = F.pmod("__draw", F.lit(buckets)).alias("__bucket")
    marked = drawn.select(bucket, "__draw", F.struct(*kept.columns).alias("__row"))
    counts = (drawn.select(bucket).groupBy("__bucket")
              .agg(F.count(F.lit(1)).alias("__n")))
    # one row per bucket of bucket_bytes each
    ahead = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__bucket", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"))
    gathered = (marked.groupBy("__bucket").agg(F.collect_list(F.struct("__draw", "__row")).alias("__rows"))
                # a fixed order first, so that a task that runs again shuffles the same sequence
                .withColumn("__rows", F.array_sort("__rows", lambda a, b: F.when(a["__draw"] < b["__draw"], -1)
                                                   .when(a["__draw"] > b["__draw"], 1).otherwise(0))))
    shuffled = gathered.withColumn("__rows", F.shuffle("__rows", F.lit(seed)))
    placed = (shuffled.join(offsets, "__bucket")
              .select("__before", F.posexplode("__rows").alias("__at", "__x"))
              .withColumn("__p", F.col("__before") + F.col("__at")))
    return placed.select(
        *[F.col("__x.__row")[c].alias(c) for c in kept.columns],
        (F.octet_length(F.coalesce(F.col("__x.__row")[text], F.lit(""))).cast("bigint") + ROW_BYTES).alias("size"),
        F.lit("rows").alias("law"), F.pmod("__p", F.lit(n_shards)).cast("int").alias("shard"),
        F.floor(F.col("__p") / n_shards).cast("bigint").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order; a shard may be several files,
    cut by slot, so that no task writes a whole shard."""
    files = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    files.write.partitionBy("shard").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = shard(docs, SHARDS)
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"), "size",
                      F.crc32(text_col(out).cast("binary")).cast("bigint").alias("text_crc32"), "law", "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
