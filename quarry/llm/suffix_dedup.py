"""Suffix-array dedup of repeated byte strings across a corpus (operator 5).

A string of ``length`` bytes is a repeat if the same string starts earlier: in
a document with a smaller id, or earlier in its own. Different texts with one id
(or none) are different documents, ordered by a 64-bit hash of the text; that
order, (doc_id, hash, start), holds in every path below. Every byte of a repeat
goes. The job, all on Spark tables:

1. Every start position belongs to the smallest-hash ``gram`` bytes inside its
   string (the leftmost of equals), its anchor. Equal strings have equal
   anchors, and neighbouring starts mostly share one, so a document becomes a
   few runs of starts per hundred bytes. Narrow rows only: anchor hash, hash of
   the run's bytes, place.
2. Anchors that occur once are done: nothing in their runs can repeat. Of runs
   with the same bytes all but the first are repeats throughout; the first
   stands for them. This takes one shuffle by anchor. Anchors that a sample of
   documents shows to be frequent are dealt over salts, and the firsts of the
   salts are brought together afterwards (the sample decides only who goes
   that way, not the result).
3. Representatives that share an anchor but differ are fetched with their
   bytes, dealt by anchor, and suffix-sorted in each task: two-stage sorting
   directly sorts only the suffixes smaller than their successors, induces the
   others by scanning the buckets of first bytes in order, and compares
   neighbours' common prefixes. Starts whose strings agree in ``length`` bytes are
   one class; all but its first are repeats.
4. An anchor with more than ``crowd`` different runs is not sorted in one task:
   its runs are cut into single strings, keyed by the string itself, and the
   first of each is found by a partial and a final minimum. Same answer.
5. The spans found go back to the documents, which drop the bytes.

Defined cases: null text is empty (and comes back so, but null with ``cut_text``); texts shorter than ``length`` stay whole;
rows that repeat in doc_id and text are one document and do not remove each
other; null doc_ids come last; an empty table gives an empty result. ``drop_repeats`` keeps all
columns. A text is one task's row: memory follows the largest text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import _bytes as b
from quarry.llm._shared import bound_arrow_batches, saved, ship_by_value, stored, text_col

LENGTH, GRAM = 100, 16
#: Different runs of one anchor beyond which they are keyed by whole strings.
CROWD = 20_000
#: Anchors met this often in one of so many documents are spread over salts, the most frequent ones first.
FREQUENT, SAMPLE_ONE_IN, MOST_FREQUENT, SALTS = 64, 64, 10_000, 64
#: Bytes of text searched for anchors at once.
CHUNK_BYTES = 1 << 19
#: Bytes of runs sorted together (the arrays take over a hundred times that).
SORT_BYTES = 1 << 19
_BITS, _DIGITS = 9, 7  # seven symbols of nine bits (a byte plus one, or the end) in a word


def _gram_hash(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes from each place on."""
    n = len(data) - gram + 1
    word, size = data.astype(np.uint64), 1
    while size < min(8, gram):  # the next 2, 4, 8 bytes as one number
        step = min(size, min(8, gram) - size)
        word = word[:len(word) - step] | (word[step:] << np.uint64(8 * step))
        size += step
    out = np.zeros(n, np.uint64)
    for at in [*range(0, gram - size, size), gram - size]:
        out += word[at:at + n]
        out *= np.uint64(b.BASE)
        out ^= out >> np.uint64(31)
    return out * np.uint64(b.BASE)


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of start positions that share an anchor: (text number, first start,
    starts, anchor hash, hash of the run's bytes)."""
    wide = length - gram + 1
    n = len(data)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    if n < length:
        return none
    grams = _gram_hash(data, gram)
    # hash above, place below: the least is the leftmost of the smallest hashes
    shift = np.uint64(max(1, int(n).bit_length()))
    least = grams & ~((np.uint64(1) << shift) - np.uint64(1))
    least |= np.arange(len(grams), dtype=np.uint64)
    # sliding minimum over `wide` places by doubling
    span = 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[:len(least) - (wide - span)], least[wide - span:])
    starts = n - length + 1
    where = (least & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    # a run begins where the anchor changes or a text begins, and ends there or where its text has no room left
    new = np.ones(starts + 1, dtype=bool)
    new[1:-1] = where[1:] != where[:-1]
    new[offsets[offsets < starts]] = True
    run = np.flatnonzero(new)
    text_no = np.searchsorted(offsets, run[:-1], side="right") - 1
    end = np.minimum(run[1:], offsets[text_no + 1] - length + 1)
    run, keep = run[:-1], end > run[:-1]
    run, count, text_no = run[keep], (end - run)[keep], text_no[keep]
    body = b.span_hash(b.prefix_hash(data), run, run + count + (length - 1))
    return text_no, run - offsets[text_no], count, b.finish(grams[where[run]]), body


#: A run's place in one number: start, number of starts below it.
START = 24


def _runs_of(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, body, doc, key, place) of ``docs`` (doc, key, text)."""
    if length >= 1 << START:
        raise ValueError(f"length {length} is not below {1 << START}")

    def find(batches):
        import pyarrow as pa
        for batch in batches:
            data, offsets = b.text_bytes(batch.column(2))
            doc, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, hi in b.chunks(offsets, CHUNK_BYTES):
                no, start, n, anchor, body = anchor_runs(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo],
                                                         length, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (anchor.view(np.int64), body.view(np.int64), doc[lo:hi][no], key[lo:hi][no], (start << START) | n)],
                    names=["anchor", "body", "doc", "key", "place"])
    return docs.mapInArrow(find, "anchor bigint, body bigint, doc bigint, key bigint, place bigint")


def _start(place):
    return F.shiftright(place, START)


def _count(place):
    return place.bitwiseAND(F.lit((1 << START) - 1))


# -- two-stage suffix sorting ---------------------------------------------------------------

def _words(symbols: np.ndarray, depth: int) -> np.ndarray:
    """At each place its next seven symbols in one number (ends padded)."""
    long = np.concatenate([symbols, np.zeros(depth + _DIGITS, np.uint64)])
    out = np.zeros(len(long) - _DIGITS + 1, np.uint64)
    for i in range(_DIGITS):
        out = (out << np.uint64(_BITS)) | long[i:len(long) - _DIGITS + 1 + i]
    return out


def _direct(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by their next ``depth`` symbols: ties of one word are
    sorted by the next, only where more than one place is left in a group."""
    order = places[np.argsort(words[places], kind="stable")]
    tied = np.arange(len(order))  # slots whose place is not yet settled
    key = words[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    for at in range(_DIGITS, depth, _DIGITS):
        group = np.cumsum(new)
        many = np.bincount(group)[group] > 1 if len(group) else new
        tied, group = tied[many], group[many]
        if not len(tied):
            break
        key = words[order[tied] + at]
        by = np.lexsort((key, group))
        order[tied] = order[tied][by]
        key = key[by]
        new = np.ones(len(tied), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
    return order


def two_stage_sort(symbols: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted places of ``symbols`` (0 ends a string) in the order of their
    suffixes, exact to ``depth`` symbols."""
    n = len(symbols)
    following = np.concatenate([symbols[1:], [0]])
    differs = np.flatnonzero(np.concatenate([symbols[1:] != symbols[:-1], [True]]))
    # in a run of one symbol the symbol after the run decides
    decides = differs[np.searchsorted(differs, np.arange(n))]
    smaller = symbols[decides] < following[decides]  # smaller than its successor: sorted directly
    # an induced suffix needs its successors up to the first that is sorted directly
    direct_at = np.flatnonzero(smaller | (symbols == 0))
    reach = direct_at[np.minimum(np.searchsorted(direct_at, np.flatnonzero(wanted)), len(direct_at) - 1)]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.flatnonzero(wanted), 1)
    np.add.at(edge, reach + 1, -1)
    needed = np.cumsum(edge)[:n] > 0
    head = smaller | (symbols == 0)
    words = _words(symbols.astype(np.uint64), depth)
    seeds = _direct(np.flatnonzero(needed & head), words, depth)
    induced = needed & ~head
    by_symbol = np.searchsorted(symbols[seeds], np.arange(258))
    queues: list[list[np.ndarray]] = [[] for _ in range(258)]
    out = []
    for c in range(257):
        batch = np.concatenate(queues[c]) if queues[c] else np.zeros(0, np.int64)
        queues[c] = []
        scanned = []
        while len(batch):  # runs of one symbol: one more symbol a round
            scanned.append(batch)
            before = batch[batch > 0] - 1
            batch = before[induced[before] & (symbols[before] == c)]
        scanned.append(seeds[by_symbol[c]:by_symbol[c + 1]])
        bucket = np.concatenate(scanned)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (symbols[before] > c)]
        if len(before):
            to = symbols[before]
            order = np.argsort(to, kind="stable")
            before, to = before[order], to[order]
            cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            for s, e in zip(cut, [*cut[1:], len(to)], strict=True):
                queues[to[s]].append(before[s:e])
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def common_prefixes(symbols: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Symbols that each suffix shares with the one before it, up to ``depth``."""
    words = _words(symbols.astype(np.uint64), depth + _DIGITS)
    out = np.zeros(len(order), np.int64)
    same = np.arange(1, len(order))
    for at in range(0, depth, _DIGITS):
        diff = words[order[same] + at] ^ words[order[same - 1] + at]
        equal = diff == 0
        out[same[equal]] += _DIGITS
        # within the differing word: leading equal symbols
        rest = diff[~equal]
        lead = np.zeros(len(rest), np.int64)
        for i in range(1, _DIGITS):
            lead += (rest >> np.uint64(_BITS * (_DIGITS - i))) == 0
        out[same[~equal]] += lead
        same = same[equal]
    return np.minimum(out, depth)


def repeats_in_runs(runs: list[bytes], starts: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int,
                    key: np.ndarray | None = None):
    """For runs of bytes with their numbers of starts and places (doc, key,
    start): (run number, first start, end of the last string) of each stretch
    of repeats."""
    key = np.zeros(len(doc), np.int64) if key is None else key
    sizes = np.array([len(r) + 1 for r in runs])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    symbols = (np.frombuffer(b"\0".join(runs) + b"\0", np.uint8).astype(np.int64) + 1)
    symbols[begin + sizes - 1] = 0
    run_no = np.repeat(np.arange(len(runs)), starts)
    place = np.arange(len(run_no)) - np.repeat(np.cumsum(starts) - starts, starts)
    wanted = np.zeros(len(symbols), dtype=bool)
    where = begin[run_no] + place
    wanted[where] = True
    order = two_stage_sort(symbols, wanted, length)
    shared = common_prefixes(symbols, order, length)
    class_no = np.cumsum(shared < length) - 1
    back = np.zeros(len(symbols), np.int64)
    back[where] = np.arange(len(where))
    item = back[order]
    d, k, p = doc[run_no[item]], key[run_no[item]], start[run_no[item]] + place[item]
    rank = np.lexsort((p, k, d, class_no))
    first = np.flatnonzero(np.concatenate([[True], class_no[rank][1:] != class_no[rank][:-1]])) if len(rank) else rank
    of = first[class_no[rank]] if len(rank) else rank
    later = (d[rank] != d[rank][of]) | (k[rank] != k[rank][of]) | (p[rank] != p[rank][of])
    hit = np.sort(item[rank[later]])
    if not len(hit):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (run_no[hit][1:] != run_no[hit][:-1])]))
    last = np.concatenate([new[1:] - 1, [len(hit) - 1]])
    no = run_no[hit[new]]
    return no, start[no] + place[hit[new]], start[no] + place[hit[last]] + length


# -- the job ----------------------------------------------------------------------------------

def _span(at, until):
    """A stretch in one number: its start and its length (below 2 ** 24)."""
    return F.shiftleft(at.cast("bigint"), 24).bitwiseOR((until - at).cast("bigint"))


def _run_spans(rows: DataFrame, length: int) -> DataFrame:
    """(doc, key, span) of whole runs."""
    start = _start(F.col("place"))
    return rows.select("doc", "key",
                       _span(start, start + _count(F.col("place")) + (length - 1)).alias("span"))


def _sorted_repeats(runs: DataFrame, length: int) -> DataFrame:
    """Stretches (doc, key, span) found by suffix sorting runs (anchor, doc,
    key, start, n, bytes) dealt and sorted by anchor."""
    def search(batches):
        import pyarrow as pa
        held: list = []
        size = 0

        def work(rows):
            doc, key, start, n = (np.array([r[i] for r in rows], dtype=np.int64) for i in (1, 2, 3, 4))
            no, at, until = repeats_in_runs([r[5] for r in rows], n, doc, start, length, key)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[no], key[no], (at << 24) | (until - at))],
                                              names=["doc", "key", "span"])
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= SORT_BYTES and held and held[-1][0] != row[0]:
                    yield work(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield work(held)
    return runs.mapInArrow(search, "doc bigint, key bigint, span bigint")


def _crowded_repeats(runs: DataFrame, length: int) -> DataFrame:
    """The same stretches for runs of crowded anchors, by whole strings."""
    one = runs.select("doc", "key", F.explode(F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1),
        lambda i: F.struct((F.col("start") + i).alias("at"),
                           F.substring(F.col("bytes"), (i + 1).cast("int"), F.lit(length)).alias("string")))).alias("s")
                      ).select("doc", "key", "s.at", F.sha2("s.string", 256).alias("string"))
    first = one.groupBy("string").agg(F.min(F.struct("doc", "key", "at")).alias("first"))
    return (one.join(first, "string").where(F.struct("doc", "key", "at") > F.col("first"))
            .select("doc", "key", _span(F.col("at"), F.col("at") + length).alias("span")))


NO_ID = (1 << 63) - 1


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the text's nulls empty, and doc (doc_id, null as the last)
    and key for doc_id. The key is the text's hash where several texts share the
    id (or have none) and 0 elsewhere, where it need not be carried about."""
    own = F.xxhash64(text)
    named = docs.withColumn(text, text_col(docs, text)).withColumn("__llm_doc", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)))
    shared = saved(named.where(F.col("__llm_doc") != NO_ID).groupBy("__llm_doc").agg(F.min(own).alias("a"), F.max(own).alias("z"))
                   .where("a <> z").select("__llm_doc"))
    if shared.limit(1).count():
        named = named.join(shared.withColumn("__llm_shared", F.lit(True)), "__llm_doc", "left")
    else:
        named = named.withColumn("__llm_shared", F.lit(None).cast("boolean"))
    return named.withColumn("__llm_key", F.when(F.col("__llm_shared") | (F.col("__llm_doc") == NO_ID), own).otherwise(
        F.lit(0).cast("bigint"))).drop("doc_id", "__llm_shared")


def repeated_spans(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, text: str = "text",
                   frequent_at: int = FREQUENT, one_in: int = SAMPLE_ONE_IN) -> DataFrame:
    """(doc, key, spans) from ``_keyed`` documents: the stretches of repeats of
    each text that has any, as an array of start << 24 | length that may overlap.
    Jobs run here; narrow rows pass through the shared checkpoint folder."""
    bound_arrow_batches(keyed.sparkSession)
    base = keyed.select(F.col("__llm_doc").alias("doc"), F.col("__llm_key").alias("key"), F.col(text).alias("text"))
    # anchors that a sample already shows to be frequent: their rows are spread over salts
    few = base.where(F.pmod(F.xxhash64("doc", "key"), F.lit(one_in)) == 0)
    frequent = saved(_runs_of(few, length, gram).groupBy("anchor").agg(F.count(F.lit(1)).alias("__n"))
                     .where(F.col("__n") >= frequent_at).orderBy(F.desc("__n"), "anchor").limit(MOST_FREQUENT).select("anchor"))
    marked = (_runs_of(base, length, gram).join(F.broadcast(frequent.withColumn("hot", F.lit(True))), "anchor", "left")
              .withColumn("hot", F.coalesce("hot", F.lit(False)))
              .withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc", "key"), F.lit(SALTS))).otherwise(F.lit(0))))
    by_body, by_anchor = Window.partitionBy("anchor", "salt", "body"), Window.partitionBy("anchor", "salt")
    place = F.struct("doc", "key", "place")
    seen = (marked.repartition("anchor", "salt").withColumn("first", F.min(place).over(by_body))
            .withColumn("lead", place == F.col("first"))
            .withColumn("kinds", F.sum(F.col("lead").cast("bigint")).over(by_anchor))
            .withColumn("rows", F.count(F.lit(1)).over(by_anchor)))
    # an anchor that occurs once is done
    known = stored(seen.where((F.col("rows") > 1) | F.col("hot")).select(
        "anchor", "body", "doc", "key", "place", "hot", "lead", "kinds"))

    # of runs with the same bytes all but the first are repeats from end to end
    found = _run_spans(known.where(~F.col("lead")), length)
    firsts = known.where(~F.col("hot") & F.col("lead") & (F.col("kinds") > 1)).select("anchor", "kinds", "doc", "key", "place").distinct()
    if frequent.limit(1).count():
        # each salt has its first; one row per salt at most remains to be compared
        leads = known.where(F.col("hot") & F.col("lead")).select("anchor", "body", "doc", "key", "place").distinct()
        best = stored(leads.groupBy("anchor", "body").agg(F.min(place).alias("first")).select(
            "anchor", "body", "first.doc", "first.key", "first.place"))
        kinds = best.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > 1)
        later = leads.join(best, ["anchor", "body", "doc", "key", "place"], "left_anti")
        found = found.union(_run_spans(later, length))
        firsts = firsts.union(best.join(kinds, "anchor").select("anchor", "kinds", "doc", "key", "place"))
    wanted = (firsts.groupBy("doc", "key")
              .agg(F.collect_list(F.struct("anchor", "kinds", "place")).alias("runs")))
    fetched = (base.join(wanted, ["doc", "key"])
               .select("doc", "key", F.encode("text", "UTF-8").alias("raw"), F.explode("runs").alias("r"))
               .select(F.col("r.anchor").alias("anchor"), "doc", "key", _start(F.col("r.place")).alias("start"),
                       _count(F.col("r.place")).alias("n"), "raw", F.col("r.kinds").alias("kinds"))
               .select("anchor", "doc", "key", "start", "n",
                       F.substring("raw", (F.col("start") + 1).cast("int"), (F.col("n") + (length - 1)).cast("int")).alias("bytes"),
                       "kinds"))
    dealt = (fetched.where(F.col("kinds") <= crowd).drop("kinds").repartition("anchor").sortWithinPartitions("anchor"))
    found = found.union(_sorted_repeats(dealt, length))
    if firsts.where(F.col("kinds") > crowd).limit(1).count():
        found = found.union(_crowded_repeats(fetched.where(F.col("kinds") > crowd), length))
    return found.groupBy("doc", "key").agg(F.collect_list("span").alias("spans"))


def drop_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD,
                 text: str = "text", cut_text: bool = False, frequent_at: int = FREQUENT,
                 one_in: int = SAMPLE_ONE_IN) -> DataFrame:
    """``docs`` with kept_bytes (binary: what remains, which may cut through a
    character), n_bytes, n_removed and n_spans (maximal removed stretches). With
    ``cut_text`` the text itself is what remains, without the rest of characters
    that were cut through."""
    names = ["kept_bytes", "n_bytes", "n_removed", "n_spans"]
    columns = [c for c in docs.columns if c not in names]
    kept, nulls = docs.select(*columns), "__llm_was_null"
    keyed = _keyed(kept.withColumn(nulls, F.col(text).isNull()) if cut_text else kept, text)
    spans = repeated_spans(keyed, length, gram, crowd, text, frequent_at, one_in)
    s = spans.select(F.col("doc").alias("__llm_doc"), F.col("key").alias("__llm_key"),
                     F.col("spans").alias("__llm_spans"))
    joined = keyed.join(s, ["__llm_doc", "__llm_key"], "left").withColumn(
        "doc_id", F.when(F.col("__llm_doc") != NO_ID, F.col("__llm_doc")).cast(kept.schema["doc_id"].dataType))
    if cut_text:
        joined = joined.withColumn(text, F.when(~F.col(nulls), F.col(text)))
    out_names = kept.columns
    joined = joined.select(*out_names, "__llm_spans")

    def cut(batches):
        import pyarrow as pa
        for batch in batches:
            given = batch.column(batch.schema.get_field_index(text))
            texts = given.to_pylist()
            spans = batch.column(batch.schema.get_field_index("__llm_spans"))
            rows = [_cut((t or "").encode(), *_unpacked(x)) for t, x in zip(texts, spans, strict=True)]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            made = [pa.array(c, type=t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            left = [batch.column(batch.schema.get_field_index(n)) for n in out_names]
            if cut_text:
                left[out_names.index(text)] = pa.array(
                    [r[0].decode("utf-8", "ignore") if r[2] else t for r, t in zip(rows, texts, strict=True)], type=given.type)
            yield pa.RecordBatch.from_arrays(left + made, names=[*out_names, *names])
    from pyspark.sql import types as T
    schema = T.StructType(list(kept.schema.fields) + [T.StructField("kept_bytes", T.BinaryType())]
                          + [T.StructField(n, T.LongType()) for n in names[1:]])
    return joined.mapInArrow(cut, schema)


def _unpacked(spans) -> tuple:
    """Starts and ends of packed stretches; (None, None) for none."""
    if not spans.is_valid:
        return None, None
    packed = spans.values.to_numpy()
    return packed >> 24, (packed >> 24) + (packed & (1 << 24) - 1)


def _cut(raw: bytes, at, until) -> tuple[bytes, int, int, int]:
    if at is None:
        return raw, len(raw), 0, 0
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, np.asarray(at), 1)
    np.add.at(edge, np.asarray(until), -1)
    gone = np.cumsum(edge)[:-1] > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), len(raw), int(gone.sum()), spans


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = drop_repeats(docs, LENGTH)
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                      F.sha2("kept_bytes", 256).alias("kept_sha256"))


ORACLE = r"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
s AS (SELECT doc_id, p, substr(h, CAST(2 * p + 1 AS BIGINT), 200) AS w
      FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM t WHERE n >= 100)),
d AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS k FROM s) WHERE k > 1),
-- repeats that touch or overlap make one removed stretch
e AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER x + 100 THEN 1 ELSE 0 END AS apart FROM d WINDOW x AS (PARTITION BY doc_id ORDER BY p)),
g AS (SELECT doc_id, p, sum(apart) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM e),
m AS (SELECT doc_id, k, min(p) AS a, max(p) + 100 AS z FROM g GROUP BY 1, 2),
c AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM m),
r AS (SELECT c.doc_id, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(z) AS last,
             string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS kept
      FROM c JOIN t USING (doc_id) GROUP BY 1)
SELECT t.doc_id, t.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM t LEFT JOIN r USING (doc_id)
"""

ship_by_value(__name__)
