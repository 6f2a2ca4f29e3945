"""Quality classifier (operator 2): hashed word n-grams, logistic regression
trained with follow-the-regularised-leader updates, scored as sparse dot products.

Words are runs of letters, of digits (all alike) or of other visible
characters, ASCII letters lower-cased. Single words and pairs of neighbours are
hashed into ``2**bits`` weights; a pair of the same word twice, and a pair or a
triple that the text had before, also count under one index each, so that
repetition is learnt whatever the words are. A text's value for an index is its share of the
text's n-grams (times a constant), so length does not count.

Training takes at most about ``max_rows`` labelled rows, chosen by a hash of
doc_id, deals them by hash to a few tasks that each run the updates in a
repeatable order, and averages the weights (one partial and one final sum).
The weight vector has a fixed size, so it goes to the driver and back to all
executors. Scoring is one pass over whole texts.

Defined cases: null and empty texts score by the bias alone; rows may repeat;
labels that are null or not 0/1 are left out, of several labels of a document
the larger counts; without any label every score is 0.5; an empty table gives
an empty result; columns named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import _bytes as b
from quarry.llm._shared import append_columns, ship_by_value

BITS = 18
#: Labelled rows that training may use (about: they are chosen by hash).
MAX_ROWS = 24_000
SHARDS, EPOCHS = 4, 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0005, 0.0001
SCALE = 8.0
THRESHOLD = 0.3

_CLASS = np.full(256, 3, dtype=np.uint8)  # other visible characters
_CLASS[b.SPACE] = 0
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[48:58] = 48


def ngrams(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all words and word pairs, text after text, and their bounds."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = _CLASS[data]
    edge = np.ones(n + 1, dtype=bool)
    edge[1:n] = kind[1:] != kind[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    word = kind[start] > 0
    start, end = start[word], end[word]
    # a run of digits counts as one digit
    end = np.where(kind[start] == 2, start + 1, end)
    hashed = b.span_hash(b.prefix_hash(_LOWER[data]), start, end)
    bounds = b.per_text(start, offsets)
    pair = b.finish(hashed[:-1] * np.uint64(b.BASE) + hashed[1:]) if len(hashed) > 1 else hashed[:0]
    inside = np.ones(len(pair), dtype=bool)
    last = bounds[1:-1] - 1
    inside[last[(last >= 0) & (last < len(pair))]] = False
    at = np.flatnonzero(inside)
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    # the same word twice, a pair seen before, a triple seen before
    same = at[hashed[at] == hashed[at + 1]]
    old = at[_seen(text_of[at], pair[at])]
    three = at[:-1][at[1:] == at[:-1] + 1] if len(at) else at
    third = three[_seen(text_of[three], b.finish(pair[three] * np.uint64(b.BASE) + hashed[np.minimum(three + 2, len(hashed) - 1)]))]
    both = np.concatenate([hashed, pair[at]]) & np.uint64((1 << bits) - 1)
    marks = [np.full(len(x), b._mixed(2000 + i) & ((1 << bits) - 1), np.uint64) for i, x in enumerate((same, old, third))]
    both = np.concatenate([both, *marks])
    place = np.concatenate([np.arange(len(hashed)), at, same, old, third])
    text_no = np.searchsorted(bounds, place, side="right") - 1
    order = np.argsort(text_no, kind="stable")
    counts = np.bincount(text_no, minlength=len(offsets) - 1)
    return both[order].astype(np.int64), np.concatenate([[0], np.cumsum(counts)])


def _seen(text_no: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Whether an equal item stands earlier in the same text."""
    key = b.finish(hashed + text_no.astype(np.uint64) * np.uint64(b.BASE))
    order = np.argsort(key, kind="stable")
    out = np.zeros(len(key), dtype=bool)
    out[order[1:]] = key[order][1:] == key[order][:-1]
    return out


def ftrl(examples, labels, bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the bias) after the updates over ``examples``, a list
    of (distinct indices, values)."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i):
        return np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))
    for _ in range(epochs):
        for (index, value), label in zip(examples, labels, strict=True):
            w = weights(index)
            p = 1.0 / (1.0 + np.exp(-max(min(float(w @ value), 30.0), -30.0)))
            g = (p - label) * value
            z[index] += g - (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA * w
            n[index] += g * g
    return weights(np.arange(size))


def _examples(column, bits: int):
    data, offsets = b.text_bytes(column)
    for lo, hi in b.chunks(offsets):
        index, bounds = ngrams(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], bits)
        for i in range(hi - lo):
            distinct, count = np.unique(index[bounds[i]:bounds[i + 1]], return_counts=True)
            value = count * (SCALE / max(1, bounds[i + 1] - bounds[i]))
            yield np.append(distinct, 1 << bits), np.append(value, 1.0)


def train(docs: DataFrame, labelled: DataFrame, bits: int = BITS, max_rows: int = MAX_ROWS,
          shards: int = SHARDS) -> np.ndarray:
    """Averaged weights. ``labelled`` has doc_id and label; jobs run here."""
    known = (labelled.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("label").cast("double").alias("label")))
    total = known.count()
    if total == 0:
        return np.zeros((1 << bits) + 1)
    share = int(min(1.0, max_rows / total) * (1 << 31))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < share)
    # about max_rows rows of two numbers: small whatever the corpus
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(shards))))

    def fit(table):
        import pyarrow as pa
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        order = np.argsort([b._mixed(int(i)) for i in table["doc_id"].to_pylist()], kind="stable")
        table = table.take(pa.array(order))
        w = ftrl(list(_examples(table["text"], bits)), table["label"].to_pylist(), bits)
        used = np.flatnonzero(w)
        return pa.table({"i": used.astype(np.int64), "w": w[used]})
    parts = rows.select("doc_id", "text", "label", "shard").groupBy("shard").applyInArrow(fit, "i bigint, w double")
    out = np.zeros((1 << bits) + 1)
    for r in parts.groupBy("i").agg(F.sum("w").alias("w")).collect():  # at most 2**bits + 1 rows
        out[r["i"]] = round(r["w"] / shards, 9)  # the order of the sum must not show
    return out


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS, text: str = "text") -> DataFrame:
    """``docs`` with score in 0..1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def kernel(column):
        data, offsets = b.text_bytes(column)
        w, out = shared.value, []
        for lo, hi in b.chunks(offsets):
            index, bounds = ngrams(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], bits)
            run = np.concatenate([[0.0], np.cumsum(w[index])])
            size = np.maximum(np.diff(bounds), 1)
            out.append((run[bounds[1:]] - run[bounds[:-1]]) * (SCALE / size) + w[-1])
        z = np.clip(np.concatenate(out) if out else np.zeros(0), -30, 30)
        return [1.0 / (1.0 + np.exp(-z))]
    return append_columns(docs, text, [("score", "double")], kernel)


def held_out(col):
    return F.crc32(F.coalesce(col, F.lit("")).cast("binary")) % 5 == 0


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = (labels.where(~held_out(F.col("doc_id").cast("string")))
             .select("doc_id", F.col("quality").alias("label")))
    out = score(docs, train(docs, learn))
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                      held_out(F.col("doc_id").cast("string")).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))


ship_by_value(__name__)
