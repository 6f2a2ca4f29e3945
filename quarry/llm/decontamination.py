"""Benchmark decontamination with suffix arrays of the training texts (operator 11).

Words are runs of ASCII letters and digits and of all characters beyond ASCII,
A-Z lower-cased. A window is ``window`` consecutive words of a benchmark item; a
shorter item is one window.

Every task holds its texts as shards of bounded size and builds a suffix array
over the words of each shard (prefix doubling on word ranks, texts do not run
into each other). Each suffix of each benchmark item is then binary-searched in
it, all suffixes at once, one word deeper per step: the interval that is left
after d words holds all places where the suffix's first d words stand, so the
depth at which it empties is the longest verbatim match, and an interval that
lasts a window gives the window's places. Places are checked against the
item's bytes, so no hash decides. A text is marked in its own row: nothing is
shuffled, however many texts share a passage.

The benchmark is measured before it leaves the cluster: up to ``block_bytes`` it
is broadcast. A larger one goes in blocks of about that size, one pass over the
texts for each (a stated query set against all rows), and the marks of a text
are brought together by a row number; only marked texts have rows there.

Defined cases: null and empty texts have no words and are clean; an item without
words is in no text; a null item_id is named ``null``; several items with one
id are one item; repeated documents are marked each; other columns are kept, but
for those named as an output; empty tables give no rows, or clean ones. A text
longer than a shard is a shard of its own: memory follows the longest text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import _bytes as b
from quarry.llm._shared import bound_arrow_batches, ship_by_value, stored

WINDOW = 10
#: Bytes of benchmark text that are broadcast at once.
BLOCK_BYTES = 16 << 20
#: Bytes of text in one shard.
SHARD_BYTES = 1 << 20
#: Places of windows that are checked at once.
PLACES = 1 << 16

#: Each byte lower-cased, and whether it belongs to a word.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True

OUTPUTS = [("n_words", "bigint"), ("n_hit", "bigint"), ("items", "array<string>"), ("longest_match", "bigint"),
           ("hit_words", "array<struct<first:bigint,last:bigint>>")]


# -- kernels ----------------------------------------------------------------------------------

def words_of(column):
    """(lower-cased bytes, starts and ends of all words, hash of each word,
    first word of each text and one more) of an Arrow string array."""
    data, offsets = b.text_bytes(column)
    return _words(_LOWER[data], offsets)


def _words(data: np.ndarray, offsets: np.ndarray):
    start, end = b.runs(_WORD[data], offsets)
    return data, start, end, b.span_hash(b.prefix_hash(data), start, end), b.per_text(start, offsets)


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``symbols`` in the order of their suffixes, exact to ``depth``
    symbols or the next 0, which ends a suffix: ranks of 1, 2, 4, ... symbols,
    each from two ranks of half the length, where suffixes are still tied."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    key = rank[order]
    new = np.ones(n, dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (key[1:] == 0)  # no two ends are alike, so nothing is compared beyond them
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # rank: first slot of the group
    slots, size = np.arange(n), 1
    while size < depth:
        last = np.ones(len(slots), dtype=bool)
        last[:-1] = new[slots[1:]] | (slots[1:] != slots[:-1] + 1)
        slots = slots[~(new[slots] & last)]
        if not len(slots):
            break
        places = order[slots]
        key = (rank[places] << 32) | np.where(places + size < n, rank[np.minimum(places + size, n - 1)], 0)
        by = np.argsort(key, kind="stable")
        order[slots], key = places[by], key[by]
        new[slots[1:]] = key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(new[slots], slots, 0))
        rank[order[slots]] = first
        size *= 2
    return order


class Suffixes:
    """All suffixes of the items of a block of the benchmark, ready for search."""

    def __init__(self, names: list[str], texts: list[str], window: int):
        import pyarrow as pa
        data, start, end, hashed, first = words_of(pa.array(texts, type=pa.large_string()))
        self.names = names
        self.vocabulary, self.word = np.unique(hashed, return_inverse=True)
        count = np.diff(first)
        self.item = np.repeat(np.arange(len(texts)), count)
        self.left = np.repeat(first[1:], count) - np.arange(len(hashed))  # words from here to the item's end
        self.window = np.minimum(window, np.repeat(count, count))
        self.data, self.start, self.end = data, start, end
        self.depth = int(self.window.max(initial=0))

    def same_bytes(self, s: np.ndarray, w: np.ndarray, data, start, end) -> np.ndarray:
        """Whether the windows from suffixes ``s`` on are, byte for byte, the words ``w`` and on."""
        mine, other = _spread(s, self.window[s]), _spread(w, self.window[s])
        size = self.end[mine] - self.start[mine]
        equal = size == end[other] - start[other]
        size = np.where(equal, size, 1)
        byte = self.data[_spread(self.start[mine], size)] == data[_spread(start[other], size)]
        equal &= np.add.reduceat(~byte, np.cumsum(size) - size) == 0 if len(size) else True
        return np.add.reduceat(~equal, np.cumsum(self.window[s]) - self.window[s]) == 0 if len(s) else equal

    def search(self, symbols: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(suffix, first slot, slots): where each suffix's window stands in the
        suffix array. A suffix whose interval empties before is nowhere in full."""
        low, high = np.zeros(len(self.word), np.int64), np.full(len(self.word), len(order), dtype=np.int64)
        alive = np.flatnonzero(self.window <= self.left)  # shorter rests of an item begin no window
        ahead = np.append(symbols, np.zeros(self.depth + 1, symbols.dtype))
        found = [np.zeros(0, np.int64)]
        for at in range(self.depth):
            wanted = self.word[alive + at] + 1
            lower = _first(ahead, order, low[alive], high[alive], at, wanted, False)
            high[alive] = _first(ahead, order, lower, high[alive], at, wanted, True)
            low[alive] = lower
            alive = alive[low[alive] < high[alive]]
            found.append(alive[self.window[alive] == at + 1])
            alive = alive[self.window[alive] > at + 1]
            if not len(alive):
                break
        which = np.concatenate(found)
        return which, low[which], (high - low)[which]


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for ``size`` numbers each, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def _first(symbols, order, low, high, at: int, wanted, behind: bool) -> np.ndarray:
    """For each interval [low, high) of the suffix array, whose suffixes agree in
    ``at`` symbols: the first slot whose next symbol is not less than the wanted
    one (``behind``: greater)."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        symbol = symbols[order[np.minimum(middle, len(order) - 1)] + at]
        right = open_ & ((symbol <= wanted) if behind else (symbol < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)


def shard_marks(suffixes: Suffixes, shard: np.ndarray, offsets: np.ndarray):
    """(n_words, marks by text number: (first hit words, last ones, items, longest))
    of a shard of texts."""
    data, start, end, hashed, first = _words(_LOWER[shard], offsets)
    n_words = np.diff(first)
    if not len(hashed) or not suffixes.depth:
        return n_words, {}
    slot = np.minimum(np.searchsorted(suffixes.vocabulary, hashed), len(suffixes.vocabulary) - 1)
    symbol = np.where(suffixes.vocabulary[slot] == hashed, slot + 1, 0)  # a word that no item has ends matches
    text_no = np.repeat(np.arange(len(n_words)), n_words)
    symbols = np.zeros(len(symbol) + len(n_words), np.int64)  # and so does the 0 behind each text
    at = np.arange(len(symbol)) + text_no
    symbols[at] = symbol
    order = suffix_array(symbols, suffixes.depth)
    which, low, size = suffixes.search(symbols, order)
    edge, longest, items = np.zeros(len(hashed) + 1, np.int64), np.zeros(len(n_words), np.int64), []
    total = np.concatenate([[0], np.cumsum(size)])
    lo = 0
    while lo < len(which):  # so many places at once
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + PLACES, side="right")) - 1)
        n = size[lo:hi]
        place = order[_spread(low[lo:hi], n)]
        s, w = np.repeat(which[lo:hi], n), np.searchsorted(at, place)
        same = suffixes.same_bytes(s, w, data, start, end)
        s, w = s[same], w[same]
        lo = hi
        np.add.at(edge, w, 1)
        np.add.at(edge, w + suffixes.window[s], -1)
        items.append(np.unique(text_no[w] * len(suffixes.names) + suffixes.item[s]))
        np.maximum.at(longest, text_no[w], _lengths(suffixes, s, w, symbol, first[text_no[w] + 1]))
    pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *items]))
    if not len(pairs):
        return n_words, {}
    texts, cut = np.unique(pairs // len(suffixes.names), return_index=True)
    hit = np.cumsum(edge)[:-1] > 0
    marks = {}
    for text, own in zip(texts.tolist(), np.split(pairs % len(suffixes.names), cut[1:]), strict=True):
        inside = np.concatenate([[False], hit[first[text]:first[text + 1]], [False]])
        turn = np.flatnonzero(inside[1:] != inside[:-1])
        marks[text] = turn[::2], turn[1::2] - 1, sorted({suffixes.names[i] for i in own.tolist()}), int(longest[text])
    return n_words, marks


def _lengths(suffixes: Suffixes, s: np.ndarray, w: np.ndarray, symbol: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Words in which suffixes and the texts from words ``w`` on agree, at least a window."""
    length, going = suffixes.window[s].copy(), np.arange(len(s))
    while len(going):
        more = (length[going] < suffixes.left[s[going]]) & (w[going] + length[going] < behind[going])
        going = going[more]
        going = going[symbol[w[going] + length[going]] == suffixes.word[s[going] + length[going]] + 1]
        length[going] += 1
    return length


# -- the job ----------------------------------------------------------------------------------

def _named(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    return (benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("name"), F.col(text).cast("string").alias("text"))
            .where(F.col("text").isNotNull()).distinct())


def _blocks(items: DataFrame, block_bytes: int) -> int:
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("name") + 16)).first()[0] or 0
    return max(1, -(-size // block_bytes))


def _marked(texts: DataFrame, keep: list[str], text: str, block, window: int, all_rows: bool, shard_bytes: int) -> DataFrame:
    """``keep`` columns and OUTPUTS of the texts searched for one block of items;
    without ``all_rows`` of the marked ones only."""
    bound_arrow_batches(texts.sparkSession)
    given = texts.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__llm_text"))
    schema = T.StructType([*given.drop("__llm_text").schema.fields,
                           *[T.StructField(n, T._parse_datatype_string(t)) for n, t in OUTPUTS]])
    sent = texts.sparkSession.sparkContext.broadcast(block)
    spans = "first", "last"

    def run(batches):
        import pyarrow as pa
        suffixes = Suffixes([r[0] for r in sent.value], [r[1] for r in sent.value], window)
        span = pa.struct([(n, pa.int64()) for n in spans])
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.list_(span)]
        for batch in batches:
            data, offsets = b.text_bytes(batch.column(len(keep)))
            rows, kept = [], []
            for lo, hi in b.chunks(offsets, shard_bytes):
                n_words, marks = shard_marks(suffixes, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                for i, n in enumerate(n_words.tolist()):
                    if i in marks:
                        at, until, items, longest = marks[i]
                        rows.append((n, int((until - at + 1).sum()), items, longest,
                                     [dict(zip(spans, x, strict=True)) for x in zip(at.tolist(), until.tolist(), strict=True)]))
                    elif all_rows:
                        rows.append((n, 0, [], 0, []))
                    else:
                        continue
                    kept.append(lo + i)
            cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
            left = batch.select(list(range(len(keep)))).take(pa.array(kept, type=pa.int64()))
            yield pa.RecordBatch.from_arrays([*left.columns, *[pa.array(c, type=t) for c, t in zip(cols, kinds, strict=True)]],
                                             schema=pa.schema([*left.schema, *[(o[0], t) for o, t in zip(OUTPUTS, kinds, strict=True)]]))
    return given.mapInArrow(run, schema)


def mark_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id",
                       item_text: str = "text", block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit (words within windows of items), items (sorted
    names of the items with windows here), longest_match (words of the longest
    verbatim match that holds a window; up to its end in the item or the text)
    and hit_words (first and last number of each stretch of hit words)."""
    outputs = [n for n, _ in OUTPUTS]
    columns = [c for c in docs.columns if c not in outputs]
    items = _named(benchmark, item, item_text)
    blocks = _blocks(items, block_bytes)
    if blocks == 1:
        block = [(r["name"], r["text"]) for r in items.collect()]  # measured: at most block_bytes
        return _marked(docs, columns, text, block, window, True, shard_bytes)
    # one pass a block; the documents are written once, so that their row numbers hold for all passes
    base = stored(docs.select(*[F.col(f"`{c}`") for c in columns], F.monotonically_increasing_id().alias("__llm_row")))
    items = stored(items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks))))
    found = None
    for i in range(blocks):
        block = [(r["name"], r["text"]) for r in items.where(F.col("block") == i).select("name", "text").collect()]
        part = _marked(base, ["__llm_row"], text, block, window, False, shard_bytes)
        found = part if found is None else found.unionByName(part)
    found = stored(found)
    place = found.select("__llm_row", F.explode("hit_words").alias("h")).select("__llm_row", F.explode(
        F.sequence("h.first", "h.last")).alias("word")).distinct()
    # consecutive hit words minus their number in the text agree within a stretch
    from pyspark.sql import Window
    numbered = place.withColumn("gap", F.col("word") - F.row_number().over(Window.partitionBy("__llm_row").orderBy("word")))
    stretch = numbered.groupBy("__llm_row", "gap").agg(F.struct(F.min("word").alias("first"), F.max("word").alias("last")).alias("s"), F.count(F.lit(1)).alias("n"))
    spans = stretch.groupBy("__llm_row").agg(F.sum("n").alias("n_hit"), F.sort_array(F.collect_list("s")).alias("hit_words"))
    others = found.groupBy("__llm_row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                                            F.max("longest_match").alias("longest_match"))
    marks = spans.join(others, "__llm_row")
    counted = _marked(base, [*columns, "__llm_row"], text, [], window, True, shard_bytes).select(*[F.col(f"`{c}`") for c in columns], "__llm_row", "n_words")
    joined = counted.join(marks, "__llm_row", "left")
    zero = {"n_hit": F.lit(0).cast("bigint"), "longest_match": F.lit(0).cast("bigint"),
            "items": F.array().cast("array<string>"), "hit_words": F.array().cast(OUTPUTS[4][1])}
    return joined.select(*[F.col(f"`{c}`") for c in columns], *[F.coalesce(F.col(n), zero[n]).alias(n) if n in zero else F.col(n) for n in outputs])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents of ``docs`` that hold no window of the benchmark."""
    outputs = [n for n, _ in OUTPUTS]
    held = {c: f"__llm_own_{c}" if c in outputs else c for c in docs.columns}
    marked = mark_contamination(docs.withColumnsRenamed(held), benchmark, **options)
    return marked.where(F.col("n_hit") == 0).select(*[F.col(f"`{h}`").alias(c) for c, h in held.items()])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marked = mark_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.select(F.col("doc_id").cast("bigint").alias("doc_id"), "n_words", "n_hit",
                         F.size("items").cast("bigint").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT id, k, array_to_string(w[p:p + k - 1], ' ') AS g
       FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM (SELECT id, w, least(10, len(w)) AS k FROM i WHERE len(w) > 0))),
dw AS (SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
m AS (SELECT r, k, p, id FROM dw JOIN iw USING (k, g)),
h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + k)) AS q FROM m) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, id FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN n USING (r)
"""

ship_by_value(__name__)
