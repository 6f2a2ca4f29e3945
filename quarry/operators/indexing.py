"""Global index, folds, hold-out split, rescaling and keep-one-per-key.

Order is semantic in the corpora (file order drives indices, folds and
keep-first), and DataFrames have none, so every operator here takes an
explicit unique ordering key.

The dense row number (G01) never pulls rows into one task: rows are
range-partitioned on the key and sorted inside each partition; a per-partition
count (one row per partition, so its size is bounded by the partition count)
is turned into offsets and broadcast back. The same trick, keyed by
(partition, group), gives per-group row numbers whose groups may be split
across many tasks, so a label holding most of the rows does not land on one
executor.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import checkpoint_dir, fix_splits, release_shuffles, staging_path

_PID_SHIFT = 33
_LOCAL_MASK = (1 << _PID_SHIFT) - 1
#: Rows (partition, group) up to which the offsets of groups are sent to the rows.
_BROADCAST_OFFSETS = 100_000


def _cols(order_by) -> list[Column]:
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def _ranked_partitions(df: DataFrame, order_by, num_partitions: int | None, keep=None):
    """Range-partition + sort, tagging each row with (partition, local position)."""
    keys = _cols(order_by)
    # range count: ``num_partitions`` or spark.sql.shuffle.partitions, which
    # a large job sizes to data / ~128 MB (asking the input for its partition
    # count would execute the adaptive plan's shuffle stages twice)
    parts = (df.repartitionByRange(num_partitions, *keys) if num_partitions
             else df.repartitionByRange(*keys))
    tagged = parts.sortWithinPartitions(*keys).withColumn(
        "_q_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_q_pid", F.shiftright("_q_mid", _PID_SHIFT)).withColumn(
        "_q_loc", F.col("_q_mid").bitwiseAND(F.lit(_LOCAL_MASK)))
    return (keep or materialize)(tagged)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``.

    The counts and the rows of an index must come from one evaluation: range
    bounds are sampled with a seed tied to the RDD, so two evaluations of the
    same plan may cut partitions differently. The checkpoint fixes the tagged
    rows once, cuts the lineage (a lost executor re-reads the files instead of
    recomputing upstream stages), and keeps nested indexes from re-running
    their inputs."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str = "rows") -> DataFrame:
    """As ``materialize``, for rows with texts: compressed Parquet in the same shared
    folder, where a checkpoint's files hold the rows as they are in memory. What was
    shuffled to make them is released."""
    path = staging_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    release_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def global_index(df: DataFrame, order_by, out: str = "idx", start: int = 0,
                 total_out: str | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """Dense row number ``start, start+1, ...`` in ``order_by`` order.

    Equal to ``row_number() over (order by ...) - 1 + start`` for a unique key,
    with no single-partition stage over the data. ``total_out`` adds the row
    count as a column (taken from the same per-partition counts, no extra pass).
    """
    tagged = _ranked_partitions(df, order_by, num_partitions)
    counts = tagged.groupBy("_q_pid").agg(F.count(F.lit(1)).alias("_q_cnt"))
    # one row per partition: a window over it is tiny by construction
    w = Window.orderBy("_q_pid")
    offsets = counts.select(
        "_q_pid",
        (F.sum("_q_cnt").over(w) - F.col("_q_cnt")).alias("_q_off"),
        F.sum("_q_cnt").over(Window.partitionBy(F.lit(1))).alias("_q_total"))
    joined = tagged.join(F.broadcast(offsets), "_q_pid")
    result = joined.withColumn(out, (F.col("_q_off") + F.col("_q_loc") + F.lit(start))
                               .cast("bigint"))
    if total_out:
        result = result.withColumn(total_out, F.col("_q_total").cast("bigint"))
    return result.drop("_q_pid", "_q_mid", "_q_loc", "_q_off", "_q_total")


def number_in_place(df: DataFrame, position: str = "position", out: str = "idx", start: int = 0,
                    total_out: str | None = None) -> DataFrame:
    """G01 in file order: the dense row number of rows as they stand in their
    files, without a shuffle.

    ``position`` is the place that the readers give: (file, block, piece,
    number). The rows of a split (file, block) lie one behind the other in one
    task, so a count per split, added up in file order, and a row's place in
    its task give its number. The counts are one narrow row per split (the only
    thing broadcast, as many as the driver's own list of splits); the rows are
    numbered where they are. Filters and projections may come before, joins and
    other shuffles may not: rows that do not lie in file order fail the job
    (``global_index`` numbers those)."""
    fix_splits(df.sparkSession)
    names = {"_q_file": "file", "_q_block": "block", "_q_piece": "piece", "_q_number": "number"}
    tagged = df.withColumns({n: F.col(f"{position}.{f}") for n, f in names.items()}).withColumn("_q_mid", F.monotonically_increasing_id())
    split, mid, number = ["_q_file", "_q_block", "_q_piece"], F.col("_q_mid"), F.col("_q_number")
    runs = tagged.select(*split, "_q_number", "_q_mid").groupBy(*split).agg(
        F.count(F.lit(1)).alias("_q_cnt"), F.min(mid).alias("_q_first"), F.max(mid).alias("_q_last"),
        F.min(number).alias("_q_low"), F.min_by(number, mid).alias("_q_at_first"),
        F.max(number).alias("_q_high"), F.max_by(number, mid).alias("_q_at_last"))
    in_order = ((F.col("_q_last") - F.col("_q_first") + 1 == F.col("_q_cnt")) & (F.col("_q_low") == F.col("_q_at_first"))
                & (F.col("_q_high") == F.col("_q_at_last")))
    w = Window.orderBy(*split)  # over one row per split
    offsets = runs.select(
        *split, F.when(in_order, F.sum("_q_cnt").over(w) - F.col("_q_cnt")).otherwise(
            F.raise_error(F.lit("rows do not lie in file order: use global_index"))).alias("_q_off"),
        F.col("_q_first").bitwiseAND(F.lit(_LOCAL_MASK)).alias("_q_loc"), "_q_cnt",
        F.sum("_q_cnt").over(Window.partitionBy(F.lit(1))).alias("_q_total"))
    joined = tagged.join(F.broadcast(offsets), split, "left")
    # a stitched record (piece 1) is the only one of its split, in whatever task it is
    nth = F.when(F.col("_q_piece") == 0, mid.bitwiseAND(F.lit(_LOCAL_MASK)) - F.col("_q_loc")).otherwise(F.lit(0))
    nth = F.when((nth >= 0) & (nth < F.col("_q_cnt")), nth).otherwise(
        F.raise_error(F.lit("the splits changed between two scans: set spark.sql.files.minPartitionNum")))
    result = joined.withColumn(out, (F.col("_q_off") + nth + F.lit(start)).cast("bigint"))
    if total_out:
        result = result.withColumn(total_out, F.col("_q_total").cast("bigint"))
    return result.drop(*names, "_q_mid", "_q_off", "_q_loc", "_q_cnt", "_q_total")


def in_file_order(df: DataFrame, order_by) -> bool:
    """Whether ``order_by`` is one column that holds the readers' places."""
    if not isinstance(order_by, str) or order_by not in df.columns:
        return False
    kind = df.schema[order_by].dataType
    return isinstance(kind, T.StructType) and kind.names == ["file", "block", "piece", "number"]


def dense_index(df: DataFrame, order_by, out: str = "idx", start: int = 0, total_out: str | None = None) -> DataFrame:
    """Numbered in place where ``order_by`` is the place in the files, by a
    range shuffle otherwise."""
    if in_file_order(df, order_by):
        return number_in_place(df, order_by, out, start, total_out)
    return global_index(df, order_by, out, start, total_out)


def global_offsets(df: DataFrame, order_by, weight: str, out: str = "offset", total_out: str | None = None) -> DataFrame:
    """Sum of ``weight`` over all rows before each row in ``order_by`` order (the
    dense index of what each row will be exploded to). Meant for narrow rows."""
    tagged = _ranked_partitions(df, order_by, None)
    sums = tagged.groupBy("_q_pid").agg(F.sum(weight).alias("_q_sum"))
    w = Window.orderBy("_q_pid")  # one row per partition
    offsets = sums.select("_q_pid", (F.sum("_q_sum").over(w) - F.col("_q_sum")).alias("_q_ahead"),
                          F.sum("_q_sum").over(Window.partitionBy(F.lit(1))).alias("_q_of"))
    within = Window.partitionBy("_q_pid").orderBy("_q_loc").rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.withColumn(out, F.coalesce(F.sum(weight).over(within), F.lit(0)))
    result = local.join(F.broadcast(offsets), "_q_pid").withColumn(out, (F.col(out) + F.col("_q_ahead")).cast("bigint"))
    if total_out:
        result = result.withColumn(total_out, F.col("_q_of").cast("bigint"))
    return result.drop("_q_pid", "_q_mid", "_q_loc", "_q_ahead", "_q_of")


def group_row_number(df: DataFrame, group_by: Sequence[str], order_by, out: str = "rn",
                     start: int = 1, group_size_out: str | None = None,
                     num_partitions: int | None = None) -> DataFrame:
    """Row number inside each group, in ``order_by`` order, skew-safe.

    Range partitioning on (group, order) splits a large group over many
    partitions; offsets come from (partition, group) counts, whose size is
    bounded by partitions + groups. Meant for low-cardinality groups such as
    labels; ``row_number().over(partitionBy)`` is fine for many small groups.
    """
    group_cols = [F.col(g) for g in group_by]
    tagged = _ranked_partitions(df, group_cols + _cols(order_by), num_partitions, stage)
    counts = tagged.groupBy("_q_pid", *group_by).agg(
        F.count(F.lit(1)).alias("_q_cnt"), F.min("_q_loc").alias("_q_first"))
    w = Window.partitionBy(*group_by).orderBy("_q_pid")
    offsets = counts.select(
        "_q_pid", *group_by, "_q_first",
        (F.sum("_q_cnt").over(w) - F.col("_q_cnt")).alias("_q_off"),
        F.sum("_q_cnt").over(Window.partitionBy(*group_by)).alias("_q_gsize"))
    # (partition, group) rows: small for label-like groups, and then the rows stay
    # where they are; their number grows with the groups, so it is measured
    small = counts.count() <= _BROADCAST_OFFSETS
    joined = tagged.join(F.broadcast(offsets) if small else offsets, ["_q_pid", *group_by])
    result = joined.withColumn(
        out, (F.col("_q_off") + F.col("_q_loc") - F.col("_q_first") + F.lit(start)).cast("bigint"))
    if group_size_out:
        result = result.withColumn(group_size_out, F.col("_q_gsize").cast("bigint"))
    return result.drop("_q_pid", "_q_mid", "_q_loc", "_q_off", "_q_first", "_q_gsize")


def fold_of(position, n, k: int) -> Column:
    """Contiguous k-fold id (1-based) of a 0-based position among n rows: the
    first ``n % k`` folds hold one row more (KFold without shuffle, = ntile)."""
    pos = F.col(position) if isinstance(position, str) else position
    total = F.col(n) if isinstance(n, str) else n
    size = F.floor(total / F.lit(k))
    rem = total - size * F.lit(k)
    big = rem * (size + 1)
    return F.when(pos < big, F.floor(pos / (size + 1)) + 1).otherwise(
        rem + F.floor((pos - big) / size) + 1).cast("bigint")


def _rows_at(df: DataFrame, keys: Sequence[Column], positions_of, num_partitions: int | None):
    """n, key values of the rows at ``positions_of(n)`` in key order, and the
    keys whose tied rows a position cuts: (key, first position, rows), in order.

    Only the key columns are indexed (a narrow range shuffle and checkpoint,
    tied keys spread by a row id); at most one row per position comes to the
    driver."""
    names = [f"_q_k{i}" for i in range(len(keys))]
    narrow = df.select(*[k.alias(n) for k, n in zip(keys, names, strict=True)],
                       F.monotonically_increasing_id().alias("_q_tie"))
    ranked = global_index(narrow, [*names, "_q_tie"], out="_q_pos", num_partitions=num_partitions)
    n = ranked.count()
    wanted = [p for p in positions_of(n) if p < n]
    rows = {r["_q_pos"]: [r[c] for c in names] for r in
            (ranked.filter(F.col("_q_pos").isin(wanted)).collect() if wanted else [])}
    cut = []
    if rows:
        cols = [F.col(c) for c in names]
        at = reduce(or_, (_same(cols, row) for row in rows.values()))
        for r in ranked.filter(at).groupBy(*names).agg(F.min("_q_pos").alias("first"), F.count(F.lit(1)).alias("n")).collect():
            if any(r["first"] < p < r["first"] + r["n"] for p in rows):
                cut.append(([r[c] for c in names], r["first"], r["n"]))
    return n, rows, sorted(cut, key=lambda c: c[1])


def _cut_at(df: DataFrame, keys: Sequence[Column], positions_of, columns_of,
            num_partitions: int | None) -> DataFrame:
    """``df`` with ``columns_of(n, behind)``, where ``behind[p]`` tells whether a
    row is at or behind position ``p`` in key order.

    Rows are compared with the keys at the positions in a map-only projection.
    Only rows tied with a key that a position cuts are ranked, by a hash of the
    row (copies in any order), so that the cut is at the exact position."""
    n, rows, cut = _rows_at(df, keys, positions_of, num_partitions)
    plain = columns_of(n, {p: _reached(keys, row) for p, row in rows.items()})
    if not cut:
        return df.withColumns(plain)
    at = reduce(or_, (_same(keys, key) for key, _, _ in cut))
    row_hash = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    tied = df.filter(at).withColumns({"_q_hash": row_hash, "_q_tie": F.monotonically_increasing_id()})
    ranked = global_index(tied, [*keys, "_q_hash", "_q_tie"], out="_q_rank", num_partitions=num_partitions)
    shift, before = F.lit(None), 0
    for key, first, count in cut:
        shift = F.when(_same(keys, key), F.lit(first - before)).otherwise(shift)
        before += count
    placed = ranked.withColumn("_q_pos", F.col("_q_rank") + shift)
    placed = placed.withColumns(columns_of(n, {p: F.col("_q_pos") >= p for p in rows}))
    return df.filter(~at).withColumns(plain).unionByName(placed.drop("_q_hash", "_q_tie", "_q_rank", "_q_pos"))


def _fold_starts(n: int, k: int) -> list[int]:
    """First position of each of k contiguous folds over n rows."""
    size, rem = divmod(n, k)
    return [i * size + min(i, rem) for i in range(k)]


def _same(keys: Sequence[Column], row: list) -> Column:
    """Whether a row's key equals ``row`` (null equals null)."""
    return reduce(and_, (key.eqNullSafe(F.lit(value)) for key, value in zip(keys, row, strict=True)))


def _reached(keys: Sequence[Column], row: list) -> Column:
    """Whether a row's key is at or behind ``row`` (nulls first, as sorted)."""
    at = F.lit(True)
    for key, value in reversed(list(zip(keys, row, strict=True))):
        ahead = F.lit(False) if value is None else key > F.lit(value)
        ahead = F.coalesce(ahead, F.lit(False)) | (key.isNotNull() if value is None else F.lit(False))
        at = ahead | (key.eqNullSafe(F.lit(value)) & at)
    return at


def kfold_contiguous(df: DataFrame, order_by, k: int = 10, fold_out: str = "fold",
                     num_partitions: int | None = None) -> DataFrame:
    """Assign each row the fold in which it is the validation part.

    The rows that begin the folds are found on the key columns alone; the rows
    themselves get their fold in a map-only projection, but for rows tied with
    the first of a fold, which are ranked (``_cut_at``). The train side of fold
    f is every row with ``fold <> f``; it is produced only when written
    (``sinks.write_folds``), so the (k-1)x copy never sits in a shuffle."""
    keys = _cols(order_by)

    def columns(n, behind):
        return {fold_out: sum((behind[p].cast("bigint") for p in _fold_starts(n, k) if p in behind), F.lit(0).cast("bigint"))}
    return _cut_at(df, keys, lambda n: _fold_starts(n, k), columns, num_partitions)


def seeded_key(idx_col, seed: int) -> Column:
    """Repeatable pseudo-random order key: md5 of ``'{seed}-{idx}'``."""
    c = F.col(idx_col) if isinstance(idx_col, str) else idx_col
    return F.md5(F.concat(F.lit(f"{seed}-"), c.cast("string")))


def seeded_shuffle(df: DataFrame, idx_col: str, seed: int = 9) -> DataFrame:
    """Rows in a fixed pseudo-random order (D16: hash order, not an RNG)."""
    return df.orderBy(seeded_key(idx_col, seed), F.col(idx_col))


def holdout_split(df: DataFrame, idx_col: str, test_fraction: float = 0.05, seed: int = 9,
                  k: int | None = 10, split_out: str = "split", fold_out: str = "fold",
                  num_partitions: int | None = None) -> DataFrame:
    """W02 (+ W01 on the train side): shuffled hold-out with a fixed seed.

    Rows are ordered by ``md5(seed-idx)``; the first ``ceil(fraction * n)``
    are ``test``. When ``k`` is given, the train rows (in that shuffled
    order, as the reference re-reads its train file) get contiguous folds. The
    boundary keys are found on the key alone; rows are compared with them in
    a map-only projection, rows tied with a boundary are ranked (``_cut_at``)."""
    key = [seeded_key(idx_col, seed)]

    def positions(n):
        test = math.ceil(n * float(test_fraction))
        return [test, *(test + p for p in (_fold_starts(n - test, k) if k else []))]

    def columns(n, behind):
        first, *starts = positions(n)
        is_test = ~behind[first] if first in behind else F.lit(n > 0)
        out = {split_out: F.when(is_test, F.lit("test")).otherwise(F.lit("train"))}
        if k:
            fold = sum((behind[p].cast("bigint") for p in starts if p in behind), F.lit(0).cast("bigint"))
            out[fold_out] = F.when(is_test, F.lit(None).cast("bigint")).otherwise(fold)
        return out
    return _cut_at(df, key, positions, columns, num_partitions)


_DIGEST = ["_q_d1", "_q_d2", "_q_d3"]
_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _digests(keys: Sequence[str]) -> dict[str, Column]:
    """Three 64-bit hashes that stand for the key columns; nulls count as values."""
    parts = [x for k in keys for x in (F.col(f"`{k}`"), F.col(f"`{k}`").isNull())]
    return {name: F.xxhash64(F.lit(i), *parts) for i, name in enumerate(_DIGEST)}


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
                        for f in df.schema.fields])


def _first_of_copies(df: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``keys`` (never null) are in ``chosen`` (one row per key), one of
    each. The window is over the join's own keys: no further shuffle or sort."""
    joined = df.join(chosen, keys)
    one = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[-1]))
    return joined.withColumn("_q_copy", one).filter("_q_copy = 1").drop("_q_copy")


def keep_one_per_key(df: DataFrame, keys: Sequence[str], order_by: str,
                     keep: str = "first") -> DataFrame:
    """Keep the first (or last) row of each key by ``order_by``, a
    column of whole numbers or the place in the files; other orders are
    ranked first.

    Texts do not take part in the choice: a hash aggregate over three 64-bit
    hashes of the key finds the least (greatest) order value, reduced in each
    map task, so a key holding a third of the rows costs no more than any
    other; buffers are of fixed width, so no row is sorted for it. A join on
    hashes and order value, which spreads the rows of one key, then fetches
    the row itself. Of rows that tie one is kept, chosen by a hash of the row;
    rows without an order value give way to all others. (``dropDuplicates``
    keeps an arbitrary row.)"""
    if in_file_order(df, order_by):
        ordered = number_in_place(df, order_by, out="_q_ord")
    elif isinstance(df.schema[order_by].dataType, _WHOLE_NUMBERS):
        ordered = df.withColumn("_q_ord", F.col(order_by).cast("bigint"))
    else:
        ordered = _with_rank(df, keys, order_by)
    first = keep == "first"
    # order value and 60 bits of the row's hash in one number of fixed width
    tie = F.pmod(_row_hash(df), F.lit(1 << 60)).cast("decimal(38,0)")
    step = F.lit(1 << 60).cast("decimal(19,0)")
    unordered = F.lit(("9" if first else "-9") + "0" * 37).cast("decimal(38,0)")
    value = F.coalesce(F.col("_q_ord").cast("decimal(19,0)") * step, unordered).cast("decimal(38,0)") + tie
    tagged = ordered.withColumns({**_digests(keys), "_q_ord": value.cast("decimal(38,0)")})
    pick = F.min if first else F.max
    chosen = tagged.groupBy(*_DIGEST).agg(pick("_q_ord").alias("_q_ord"))
    return _first_of_copies(tagged, chosen, [*_DIGEST, "_q_ord"]).select(*df.columns)


def _with_rank(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """``_q_ord``: the dense rank of each order value; only order values move."""
    values = df.select(F.col(order_by).alias("_q_value")).distinct()
    ranks = global_index(values, "_q_value", out="_q_ord")
    return df.join(ranks, df[order_by].eqNullSafe(ranks["_q_value"]), "left").withColumn(
        "_q_ord", F.when(F.col(order_by).isNotNull(), F.col("_q_ord"))).drop("_q_value")


def drop_duplicate_pairs(df: DataFrame, keys: Sequence[str], order_by: str,
                         idx_out: str = "idx", start: int = 1) -> DataFrame:
    """Keep the first row per key (``drop_duplicates``), then a dense
    index from ``start`` in the original order.

    Hashes of the keys and the order values alone are ranked; the first rank of
    each key and its dense number are found on them, and the rows are fetched
    by one join."""
    tagged = df.withColumns({**_digests(keys), "_q_tie": _row_hash(df)})
    by = [*_DIGEST, "_q_tie"]
    order = F.col(f"`{order_by}`")
    narrow = tagged.select(*by, order.alias("_q_value")).distinct()
    ranked = global_index(narrow, ["_q_value", *by], out="_q_rank")
    firsts = ranked.groupBy(*_DIGEST).agg(F.min("_q_rank").alias("_q_rank"))
    numbered = global_index(firsts.select("_q_rank"), "_q_rank", out="_q_idx", start=start)
    chosen = ranked.join(numbered, "_q_rank").select(*by, "_q_value", "_q_idx").withColumnRenamed("_q_value", "_q_wanted")
    joined = tagged.join(chosen, by).filter(order.eqNullSafe(F.col("_q_wanted")))
    one = F.row_number().over(Window.partitionBy(*by).orderBy("_q_tie"))
    kept = joined.withColumn("_q_copy", one).filter("_q_copy = 1").withColumn(idx_out, F.col("_q_idx"))
    return kept.select(*[c for c in df.columns if c != idx_out], idx_out)


#: Parts into which a round of the threshold search cuts the range of keys.
_PARTS = 4096


def _cuts_by_histogram(narrow: DataFrame, group_col: str, limits: DataFrame, limit_col: str) -> DataFrame:
    """(group, cut, need, here): the order value of the last row within the quota, how many
    of its ``here`` rows are within it. Each round counts the rows of the part in question
    in ``_PARTS`` parts of its range, until the part is one value: six rounds for any 64-bit key."""
    need = F.col(limit_col).cast("bigint")
    state = (narrow.groupBy(group_col).agg(F.min("_q_key").alias("lo"), F.max("_q_key").alias("hi"), F.count(F.lit(1)).alias("here"))
             .join(limits.select(group_col, limit_col), group_col).where(need > 0)
             .select(group_col, "lo", "hi", "here", F.least(need, F.col("here")).alias("need")))
    state = materialize(state)
    while state.where("lo < hi").limit(1).count():
        # rows of finished groups are not counted again
        open_ = state.where("lo < hi").withColumn("width", F.ceil((F.col("hi") - F.col("lo") + 1) / _PARTS).cast("decimal(38,0)"))
        part = F.floor((F.col("_q_key") - F.col("lo")) / F.col("width")).cast("int")
        counts = (narrow.join(open_.select(group_col, "lo", "hi", "width"), group_col).where("_q_key between lo and hi")
                  .groupBy(group_col, part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("_q_key").alias("low"), F.max("_q_key").alias("high")))
        w = Window.partitionBy(group_col).orderBy("part")  # at most _PARTS rows
        running = counts.withColumn("upto", F.sum("n").over(w)).join(open_.select(group_col, "need"), group_col)
        hit = running.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
        # a part that is taken whole ends with its own greatest key; that key decides
        found = hit.select(group_col, F.col("low").alias("lo"), F.col("high").alias("hi"), F.col("n").alias("here"),
                           (F.col("need") - (F.col("upto") - F.col("n"))).alias("need"))
        state = materialize(state.where("lo = hi").unionByName(found))
    return state.select(group_col, F.col("lo").alias("cut"), "need", "here")


def _cuts_by_rank(narrow: DataFrame, group_col: str, limits: DataFrame, limit_col: str) -> DataFrame:
    """The same for keys of other types: ranked without the rows they belong to."""
    ranked = group_row_number(narrow, [group_col], "_q_key", out="_q_rn").join(limits.select(group_col, limit_col), group_col)
    values = ranked.groupBy(group_col, "_q_key").agg(F.min("_q_rn").alias("first"), F.count(F.lit(1)).alias("here"), F.max(limit_col).alias("quota"))
    inside = values.where(F.col("first") <= F.col("quota"))
    last = inside.groupBy(group_col).agg(F.max("first").alias("first"))
    return materialize(inside.join(last, [group_col, "first"]).select(
        group_col, F.col("_q_key").alias("cut"), F.least(F.col("quota") - F.col("first") + 1, F.col("here")).cast("bigint").alias("need"), "here"))


def head_per_group(df: DataFrame, group_col: str, order_by, limits: DataFrame,
                   limit_col: str = "quota") -> DataFrame:
    """First ``quota`` rows of each group (quota table: group, quota), by
    ascending ``order_by`` (nulls first).

    The order value at which a group's quota is reached is searched on (group,
    order value) alone - by histograms for whole numbers, no row is sorted -
    and the rows are filtered by it where they are. Only rows that tie with it,
    where not all of them are within the quota, are ranked, by a hash of the row."""
    key = F.col(order_by) if isinstance(order_by, str) else order_by
    whole = isinstance(df.select(key.alias("k")).schema["k"].dataType, _WHOLE_NUMBERS)
    lowest = F.lit("-1" + "0" * 19).cast("decimal(38,0)")
    key = F.coalesce(key.cast("decimal(38,0)"), lowest) if whole else key
    narrow = materialize(df.select(F.col(group_col), key.alias("_q_key")))
    cuts = (_cuts_by_histogram if whole else _cuts_by_rank)(narrow, group_col, limits, limit_col)
    tagged = df.withColumn("_q_key", key).join(
        cuts.withColumnRenamed("need", "_q_need").withColumnRenamed("here", "_q_here").withColumnRenamed("cut", "_q_cut"), group_col)
    same = F.col("_q_key").eqNullSafe(F.col("_q_cut"))
    before = F.col("_q_cut").isNotNull() & (F.col("_q_key").isNull() | (F.col("_q_key") < F.col("_q_cut")))
    before = F.coalesce(before, F.lit(False))
    some = F.col("_q_need") < F.col("_q_here")
    out = tagged.filter(before | (same & ~some))
    if cuts.where("need < here").limit(1).count():
        tied = group_row_number(tagged.filter(same & some).withColumn("_q_hash", _row_hash(df)), [group_col], ["_q_hash"], out="_q_rn")
        out = out.unionByName(tied.filter(F.col("_q_rn") <= F.col("_q_need")).drop("_q_rn", "_q_hash"))
    return out.select(*df.columns)


# Target label distribution of the rescaling job, in the order
# the anchors are tried.
RESCALE_DISTRIBUTION = [("support", 22.46), ("deny", 14.13), ("comment", 18.34),
                        ("unrelated", 45.07)]


def rescale_quotas(df: DataFrame, label_col: str,
                   distribution=RESCALE_DISTRIBUTION) -> DataFrame:
    """Quota table (label, quota) for W03, computed by Spark from label counts.

    For anchors in order, every other label l needs ``w_l / w_a * n_a <= n_l``;
    the first anchor meeting that for all labels wins. Quota = ``int(size)+1``
    (the anchor keeps all rows), D13. No anchor -> the job fails."""
    spark = df.sparkSession
    # (anchor, label) pairs of the distribution: a 16-row literal table
    pairs_lit = spark.createDataFrame(
        [(la, wa, ra, lb, wb) for ra, (la, wa) in enumerate(distribution)
         for (lb, wb) in distribution],
        "a_label string, a_weight double, a_rank int, b_label string, b_weight double")
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    a_counts = counts.select(F.col("label").alias("a_label"), F.col("n").alias("a_n"))
    b_counts = counts.select(F.col("label").alias("b_label"), F.col("n").alias("b_n"))
    pairs = (pairs_lit.join(F.broadcast(a_counts), "a_label", "left")
             .join(F.broadcast(b_counts), "b_label", "left")
             .fillna(0, ["a_n", "b_n"])
             .withColumn("size", F.col("b_weight") / F.col("a_weight") * F.col("a_n")))
    ok = pairs.groupBy("a_label", "a_rank").agg(
        F.min(F.when(F.col("a_label") == F.col("b_label"), F.lit(True))
              .otherwise(F.col("size") <= F.col("b_n"))).alias("ok"))
    chosen = ok.filter("ok").agg(F.min("a_rank").alias("anchor_rank"))
    sizes = pairs.join(F.broadcast(chosen), F.col("a_rank") == F.col("anchor_rank"))
    quotas = sizes.select(
        F.col("b_label").alias(label_col),
        F.when(F.col("a_label") == F.col("b_label"), F.col("b_n") + 1)
        .otherwise(F.floor(F.col("size")).cast("bigint") + 1).alias("quota"))
    return quotas.withColumn(
        "quota", F.when(F.col("quota").isNull(),
                        F.raise_error(F.lit("no anchor label fits the target distribution")))
        .otherwise(F.col("quota")))


def rescale_to_distribution(df: DataFrame, label_col: str, order_by: str,
                            distribution=RESCALE_DISTRIBUTION) -> DataFrame:
    """Downsample labels toward the target mix; keeps file order per label.

    A label outside the distribution is an error, as in the reference."""
    allowed = [lbl for lbl, _ in distribution]
    checked = df.withColumn(label_col, F.when(F.col(label_col).isin(allowed), F.col(label_col))
                            .otherwise(F.raise_error(F.concat(F.lit("label outside distribution: "),
                                                              F.coalesce(F.col(label_col), F.lit("NULL"))))))
    quotas = rescale_quotas(checked, label_col, distribution)
    return head_per_group(checked, label_col, order_by, quotas, "quota")
