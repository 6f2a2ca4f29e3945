"""Quality rules as a short-circuit cascade (operator 4).

A rule looks at features of a text and rejects it or not. ``estimate`` runs
every rule alone on a bounded sample inside a task and measures its cost
(seconds per MB) and selectivity (share rejected); ``order_rules`` sorts by
rejection per cost. ``cascade`` applies the rules in that order to whole texts
in Arrow batches: a rule sees only the texts that all earlier rules kept and
computes only the features it needs for them. The order changes the work, never
the verdict: a text is kept if no rule rejects it.

Defined cases: null text is a text without words (rejected as too short);
repeated rows are judged each and alike; an empty table gives an empty result;
columns named like a result are replaced, all others stay. Memory follows the
largest text of a batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import _bytes as b
from quarry.llm._shared import append_columns, ship_by_value

#: Rows of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 512
WINDOW = 8

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


class View:
    """Some texts of a batch with the features computed for them so far."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.made: dict[str, np.ndarray] = {}
        self.shared: dict[str, tuple] = {}

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, keep: np.ndarray) -> View:
        if keep.all():
            return self
        sizes = np.diff(self.offsets)
        out = View(self.data[np.repeat(keep, sizes)], np.concatenate([[0], np.cumsum(sizes[keep])]))
        out.made = {k: v[keep] for k, v in self.made.items()}
        return out

    def words(self):
        if "words" not in self.shared:
            start, end = b.runs(~b.SPACE[self.data], self.offsets)
            self.shared["words"] = (start, end, b.per_text(start, self.offsets))
        return self.shared["words"]

    def prefix(self):
        if "prefix" not in self.shared:
            self.shared["prefix"] = (b.prefix_hash(self.data),)
        return self.shared["prefix"][0]

    def feature(self, name: str) -> np.ndarray:
        if name not in self.made:
            self.made[name] = FEATURES[name](self)
        return self.made[name]


def _repeats(text_no: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items of texts: whether an equal item of the same text exists, and
    whether it is not the group's first in sort order."""
    key = b.finish(hashed + text_no.astype(np.uint64) * np.uint64(b.BASE))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later, shared = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
    later[order[1:]] = same
    shared[order[1:]] |= same
    shared[order[:-1]] |= same
    return shared, later


def _n_words(v: View) -> np.ndarray:
    return np.diff(v.words()[2])


def _word_chars(v: View) -> np.ndarray:
    return b.sums(~b.SPACE[v.data] & ((v.data & 0xC0) != 0x80), v.offsets)


def _n_symbols(v: View) -> np.ndarray:
    return b.sums(_SYMBOL[v.data], v.offsets)


def _lines(v: View) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start, end = b.runs(v.data != 10, v.offsets)
    words = v.words()[0]
    worded = np.searchsorted(words, end) > np.searchsorted(words, start)
    start, end = start[worded], end[worded]
    return start, end, np.searchsorted(v.offsets, start, side="right") - 1


def _n_lines(v: View) -> np.ndarray:
    return np.bincount(_lines(v)[2], minlength=len(v)).astype(np.int64)


def _n_dup_lines(v: View) -> np.ndarray:
    start, end, text_no = _lines(v)
    _, later = _repeats(text_no, b.span_hash(v.prefix(), start, end))
    return np.bincount(text_no[later], minlength=len(v)).astype(np.int64)


def _n_repeat_words(v: View) -> np.ndarray:
    start, end, bounds = v.words()
    text_no = np.repeat(np.arange(len(v)), np.diff(bounds))
    at = np.flatnonzero(np.arange(len(start)) + WINDOW <= bounds[text_no + 1]) if len(start) else np.zeros(0, np.int64)
    if not len(at):
        return np.zeros(len(v), np.int64)
    word = b.span_hash(v.prefix(), start, end)
    window = np.zeros(len(at), dtype=np.uint64)
    for j in range(WINDOW):
        window = window * np.uint64(b.BASE) + word[at + j]
    shared, _ = _repeats(text_no[at], b.finish(window))
    edge = np.zeros(len(start) + WINDOW + 1, dtype=np.int64)
    np.add.at(edge, at[shared], 1)
    np.add.at(edge, at[shared] + WINDOW, -1)
    return b.sums(np.cumsum(edge)[:len(start)] > 0, bounds)


def _n_same_words(v: View) -> np.ndarray:
    """Words equal to the word before them."""
    start, end, bounds = v.words()
    if not len(start):
        return np.zeros(len(v), np.int64)
    word = b.span_hash(v.prefix(), start, end)
    same = np.zeros(len(word), dtype=bool)
    same[1:] = word[1:] == word[:-1]
    same[bounds[:-1][bounds[:-1] < len(word)]] = False
    return b.sums(same, bounds)


FEATURES: dict[str, Callable[[View], np.ndarray]] = {
    "n_words": _n_words, "word_chars": _word_chars, "n_symbols": _n_symbols, "n_lines": _n_lines,
    "n_dup_lines": _n_dup_lines, "n_repeat_words": _n_repeat_words, "n_same_words": _n_same_words,
}


@dataclass(frozen=True)
class Rule:
    """``rejects(view)`` is true for each text that the rule turns down."""
    name: str
    rejects: Callable[[View], np.ndarray]


def too_short(v: View) -> np.ndarray:
    return v.feature("n_words") < 20


def repeats_itself(v: View) -> np.ndarray:
    return 100 * v.feature("n_repeat_words") > 30 * v.feature("n_words")


def symbol_heavy(v: View) -> np.ndarray:
    """More than three symbols to ten words."""
    return 10 * v.feature("n_symbols") > 3 * v.feature("n_words")


def same_lines(v: View) -> np.ndarray:
    """More than half of the lines with a word repeat an earlier one."""
    return 2 * v.feature("n_dup_lines") > v.feature("n_lines")


def odd_word_length(v: View) -> np.ndarray:
    """Mean word length below 2 or above 15 code points."""
    n, chars = v.feature("n_words"), v.feature("word_chars")
    return (chars < 2 * n) | (chars > 15 * n)


def stutters(v: View) -> np.ndarray:
    """More than three words in ten equal the word before them."""
    return 10 * v.feature("n_same_words") > 3 * v.feature("n_words")


BASE_RULES = (Rule("too_short", too_short), Rule("repeats_itself", repeats_itself))
MORE_RULES = (Rule("symbol_heavy", symbol_heavy), Rule("same_lines", same_lines),
              Rule("odd_word_length", odd_word_length), Rule("stutters", stutters))
RULES = BASE_RULES + MORE_RULES


def estimate(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Seconds per MB and share rejected of each rule, on at most ``sample_rows`` rows."""
    def measure(batches):
        import time

        import pyarrow as pa
        for batch in batches:
            data, offsets = b.text_bytes(batch.column(0))
            rows = []
            for rule in rules:
                view, began = View(data, offsets), time.thread_time()
                rejected = int(rule.rejects(view).sum())
                rows.append((rule.name, len(view), len(data), time.thread_time() - began, rejected))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)],
                                             names=["rule", "texts", "bytes", "seconds", "rejected"])
    sample = docs.select(text).limit(sample_rows)
    parts = sample.mapInArrow(measure, "rule string, texts bigint, bytes bigint, seconds double, rejected bigint")
    rows = {r["rule"]: r for r in parts.groupBy("rule").agg(
        *(F.sum(c).alias(c) for c in ("texts", "bytes", "seconds", "rejected"))).collect()}
    out = []
    for rule in rules:
        r = rows.get(rule.name)
        out.append({"rule": rule.name,
                    "cost": r["seconds"] / max(r["bytes"], 1) * 1e6 if r else 0.0,
                    "selectivity": r["rejected"] / max(r["texts"], 1) if r else 0.0})
    return out


def order_rules(rules, estimates: list[dict]) -> tuple[Rule, ...]:
    """Rules by rejection per cost, highest first; equals keep their order."""
    by = {e["rule"]: e["selectivity"] / max(e["cost"], 1e-9) for e in estimates}
    return tuple(sorted(rules, key=lambda r: -by.get(r.name, 0.0)))


def cascade(docs: DataFrame, rules=RULES, text: str = "text", features: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``features`` of every text, kept, and failed_rule (the first
    rule, in the order given, that rejected the text; null if kept)."""
    def kernel(column):
        data, offsets = b.text_bytes(column)
        made = {f: [] for f in features}
        failed: list[np.ndarray] = []
        for lo, hi in b.chunks(offsets):
            view = View(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            for f in features:
                made[f].append(view.feature(f))
            first, alive = np.full(hi - lo, -1), np.arange(hi - lo)
            for i, rule in enumerate(rules):
                if not len(alive):
                    break
                bad = rule.rejects(view)
                first[alive[bad]] = i
                alive, view = alive[~bad], view.take(~bad)
            failed.append(first)
        whole = np.concatenate(failed) if failed else np.zeros(0, np.int64)
        names = [r.name for r in rules]
        return ([np.concatenate(made[f]) if made[f] else np.zeros(0, np.int64) for f in features]
                + [whole < 0, [names[i] if i >= 0 else None for i in whole.tolist()]])
    fields = [(f, "bigint") for f in features] + [("kept", "boolean"), ("failed_rule", "string")]
    return append_columns(docs, text, fields, kernel)


def quality_rules(docs: DataFrame, rules=RULES, text: str = "text", features: tuple[str, ...] = ()) -> DataFrame:
    """Estimate on a sample (one small job), order, and apply the cascade."""
    return cascade(docs, order_rules(rules, estimate(docs, rules, text)), text, features)


BASE_FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = quality_rules(docs, RULES, features=BASE_FEATURES)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"), *BASE_FEATURES, base.alias("base_failed"), "kept")


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
base AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM t),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
worded AS (SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2),
dups AS (SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines, CAST(sum(n) AS BIGINT) AS n_lines FROM worded GROUP BY 1),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t),
win AS (SELECT doc_id, i, CASE WHEN i + 7 <= len(w) THEN array_to_string(w[i:i + 7], ' ') END AS win FROM pos),
flag AS (SELECT doc_id, i, win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 AS again FROM win),
cover AS (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c FROM flag),
rep AS (SELECT doc_id, CAST(count(*) FILTER (WHERE c) AS BIGINT) AS n_repeat_words FROM cover GROUP BY 1),
step AS (SELECT doc_id, CAST(count(*) FILTER (WHERE w[i] = w[i - 1]) AS BIGINT) AS n_same FROM pos WHERE i > 1 GROUP BY 1),
f AS (SELECT doc_id, coalesce(n_same, 0) AS n_same, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM base LEFT JOIN dups USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN step USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > 3 * n_words
            OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_same > 3 * n_words) AS kept
FROM f
"""

ship_by_value(__name__)
