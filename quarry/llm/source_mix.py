"""Mixing sources to target weights by weighted fair queueing (operator 8).

Targets: sources in code-point order (null last) weigh 1, 2, 3, 1, ... and
share ``budget`` words (by default all words) in proportion; no target exceeds
``most`` times its source's words, and what that frees is shared again by
weight until no target is above. Only the share per weight changes from round
to round, so a round is one aggregate over the source table.

Queue: each source's documents stand in a seeded hash order and pass up to
``most`` times. A document's virtual finish time is its source's words up to
and including it, divided by the source's target. All passes are ordered by
that time (ties by source, then pass) and cut where the running total of words
would exceed the budget; only whole documents are taken.

Running totals never gather a source in one task: a source is cut into slices
by its hash order, and the time axis into equal slices, each summed by itself;
offsets come from one row per slice.

Defined cases: null text has size 0; documents without words take nothing and
count as taken once if their time comes; repeated rows are documents of their
own; an empty table gives an empty result; a table without words has targets
and takes of 0; columns named like a result are replaced, others stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import running_sum, saved, ship_by_value, text_col
from quarry.operators.indexing import global_index

#: Times a document may be taken at most; weights by rank of the source.
MOST, WEIGHTS = 3, (1, 2, 3)
SEED = 17
#: Slices of a source's hash order (16 ** digits), and of virtual time up to 2 and per doubling beyond.
HASH_DIGITS, TIME_SLICES = 3, 1024

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    """Number of words of a text column: starts of runs of other than the six ASCII spaces."""
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST, budget: int | None = None) -> DataFrame:
    """``sources`` (source, source_size) with rank, weight and target."""
    named = sources.withColumn("__null", F.col("source").isNull())
    ranked = global_index(named, ["__null", "source"], out="rank").drop("__null")
    ranked = saved(ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                            (F.col("rank") % len(weights) + 1).cast("int")).cast("double")))
    limit = F.lit(most) * F.col("source_size")
    first = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total = float(budget if budget is not None else first[0] or 0)
    rest, weight, capped = total, first[1] or 1.0, 0
    while True:
        above = limit.cast("double") < F.col("weight") * F.lit(rest) / F.lit(weight)
        r = ranked.agg(F.count_if(above), F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))).first()
        if (r[0] or 0) <= capped:
            break
        capped = r[0]
        if r[2] is None:  # every source is at its limit: the budget is larger than all passes together
            return ranked.withColumn("target", limit.cast("double"))
        rest, weight = total - float(r[1] or 0), r[2]
    share = F.col("weight") * F.lit(rest) / F.lit(weight)
    return ranked.withColumn("target", F.when(limit.cast("double") < share, limit.cast("double")).otherwise(share))


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, budget: int | None = None, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, text_key, size, source_size, target, repeats
    (times taken) and taken (words). Jobs run here; narrow rows are kept in the
    shared checkpoint folder."""
    text = text_col(docs)
    narrow = saved(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                               word_count(text).alias("size"), F.xxhash64(text).alias("text_key")))
    per_source = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most, budget)
    per_source = saved(per_source.select("source", "source_size", "rank", "target"))
    total = budget if budget is not None else per_source.agg(F.sum("source_size")).first()[0] or 0
    key = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                .cast("binary"))
    queued = narrow.withColumn("key", key).withColumn("__slice", F.substring("key", 1, HASH_DIGITS))
    queued = running_sum(queued, ["source"], ["key", "text_key"], "size", "so_far", "__slice")
    s = per_source.withColumnRenamed("source", "__source")
    queued = saved(queued.join(s, F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "__slice", "key"))

    def time(n):
        return F.when(F.col("target") > 0, (n * F.col("source_size") + F.col("so_far")).cast("double") / F.col("target")
                      ).otherwise(F.lit(0.0))
    passes = queued.where("size > 0").select("size", "rank", F.explode(F.array(*(
        F.struct(F.lit(i).alias("nth"), time(F.lit(i)).alias("time")) for i in range(most)))).alias("p")
    ).select("size", "rank", "p.nth", "p.time")
    # a target is reached at time 1; later times, which a large source of small weight fills, get slices by ratio
    passes = passes.withColumn("__slice", F.when(F.col("time") < 2, F.floor(F.col("time") * TIME_SLICES)).otherwise(
        TIME_SLICES + F.floor(F.log2("time") * TIME_SLICES)))
    summed = running_sum(passes, [], ["time", "rank", "nth"], "size", "through", "__slice")
    last = summed.where(F.col("through") <= F.lit(total)).agg(F.max(F.struct("time", "rank", "nth")).alias("x")).first()["x"]
    if last is None:
        repeats = F.lit(0)
    else:
        end = F.struct(F.lit(last["time"]).alias("time"), F.lit(last["rank"]).alias("rank"), F.lit(last["nth"]).alias("nth"))
        repeats = sum(((F.struct(time(F.lit(i)).alias("time"), F.col("rank"), F.lit(i).alias("nth")) <= end).cast("int")
                       for i in range(most)), F.lit(0))
        repeats = F.when(F.col("size") > 0, repeats).otherwise(F.least(repeats, F.lit(1)))
    return queued.withColumn("repeats", repeats.cast("int")).select(
        "doc_id", "text_key", "source", "size", "source_size", "target", "repeats",
        (F.col("size") * F.col("repeats")).alias("taken"))


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    chosen = mix(docs, **options).select(
        F.col("doc_id").alias("__llm_doc"), F.col("text_key").alias("__llm_key"), F.col("source").alias("__llm_src"), "repeats")
    # rows that agree in doc_id, source and text stand for each other: one of them carries all their takes
    chosen = chosen.groupBy("__llm_doc", "__llm_key", "__llm_src").agg(
        F.count(F.lit(1)).alias("__llm_rows"), F.sum("repeats").alias("__llm_n")).where("__llm_n > 0")
    same = docs.join(chosen, docs["doc_id"].cast("bigint").eqNullSafe(F.col("__llm_doc"))
                     & docs["source"].cast("string").eqNullSafe(F.col("__llm_src"))
                     & (F.xxhash64(text_col(docs)) == F.col("__llm_key")))
    both = same.where(F.col("__llm_rows") == 1)
    if chosen.where("__llm_rows > 1").limit(1).count():
        both = both.unionByName(
            same.where(F.col("__llm_rows") > 1).dropDuplicates(["__llm_doc", "__llm_key", "__llm_src"]))
    return both.withColumn("__llm_nth", F.explode(F.sequence(F.lit(1), F.col("__llm_n")))).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs, WEIGHTS, MOST).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (SELECT doc_id, source,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM s),
w AS (SELECT *, CAST(1 + rank % 3 AS DOUBLE) AS weight, 3 * source_size AS most FROM r),
-- sources reach their limit in the order of limit per weight
o AS (SELECT *, row_number() OVER x AS k, sum(most) OVER x AS most_k, sum(weight) OVER x AS weight_k,
             (SELECT sum(source_size) FROM w) AS total, (SELECT sum(weight) FROM w) AS weights
      FROM w WINDOW x AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
c AS (SELECT *, CAST(total - (most_k - most) AS DOUBLE) AS rest, weights - (weight_k - weight) AS left_weight FROM o),
f AS (SELECT rest, left_weight FROM c WHERE NOT (CAST(most AS DOUBLE) < weight * rest / left_weight) ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, rank, CASE WHEN CAST(most AS DOUBLE) < weight * f.rest / f.left_weight
             THEN CAST(most AS DOUBLE) ELSE weight * f.rest / f.left_weight END AS target FROM w, f),
q AS (SELECT d.doc_id, d.size, t.source_size, t.rank, t.target,
             sum(d.size) OVER (PARTITION BY t.rank ORDER BY md5('17-' || coalesce(CAST(d.doc_id AS VARCHAR), ''))
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT q.*, nth, CASE WHEN target > 0 THEN CAST(nth * source_size + so_far AS DOUBLE) / target ELSE 0 END AS tm
      FROM q, (SELECT unnest([0, 1, 2]) AS nth) WHERE size > 0),
u AS (SELECT *, sum(size) OVER (ORDER BY tm, rank, nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through FROM p),
g AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM u
      WHERE through <= (SELECT sum(source_size) FROM s) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(g.taken, 0) AS taken FROM q LEFT JOIN g USING (doc_id)
"""

ship_by_value(__name__)
