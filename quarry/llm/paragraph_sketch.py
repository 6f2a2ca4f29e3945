"""Document fingerprints by invertible Bloom lookup sketches (operator 3).

A text's paragraphs are its lines, long ones cut where their own words say so:
after a word that ends as ``CUT`` names, ``LEAST_CHARS`` characters on at the
earliest (``TAIL_LEAST_CHARS`` in a text's last ``TAIL_CHARS``, so that short texts
have several), and after ``PIECE_CHARS`` characters where no such word comes. An
inserted or changed word thus moves the cuts near it only. Paragraphs are
hashed to 64-bit digests, taken as a set. A sketch has three tables of cells; a
digest falls into one cell of each, chosen by its own bits, and a cell holds
the number of its digests, their xor and the xor of their checks. Subtracting
the cells of two versions leaves only the digests they do not share, and
peeling recovers these: a cell left with one digest names it, which is then
taken out of its other cells. If cells remain, the sketches were too small for
the difference, and both versions are sketched again with more cells: in
blocks chosen by further bits of the digest, as many as the paragraph counts ask
for, and a block that fails is tried again with twice the cells and other
places. Likeness is shared / all distinct
paragraphs, from the recovered differences and the two counts.

The fingerprint is the count, a hash of the whole text, and the first and
smallest sketch; two texts that differ little are compared from fingerprints
alone. Built-in DataFrame functions only.

The next document (descending doc_id) is found without one global sort: rows
are dealt by doc_id ranges of about equal row counts, ordered in each range, and
the first row of the next lower range follows a range's last. The rows of a
doc_id (or of none) that would fill several ranges are dealt by their text's hash.

Defined cases: null text is empty (no paragraphs; two empty texts are alike,
1.0); equal doc_ids are ordered by the text's hash, then the text; null doc_ids
come last; a single row follows itself; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._shared import text_col

PIECE_CHARS, LEAST_CHARS = 256, 64
TAIL_CHARS, TAIL_LEAST_CHARS = 300, 16
#: Ends of words after which a long line may be cut.
CUT = "(?:[ds.,;:!?] |[。！？])"
PIECE = (rf"(?s)(?:(?!.{{{TAIL_CHARS}}})[^\n]{{{TAIL_LEAST_CHARS},{PIECE_CHARS}}}?{CUT}|[^\n]{{{LEAST_CHARS},{PIECE_CHARS}}}?{CUT}"
         rf"|[^\n]{{1,{PIECE_CHARS}}})\n*")
#: Cells per table of the fingerprint's sketch, of a block's first and of its larger sketches.
FIRST_CELLS, BLOCK_CELLS, LARGER_CELLS = 4, 8, 16
#: Digests of both sides in a block on average, and larger sketches tried.
BLOCK_LOAD, RETRIES = 8, 4
TABLES, ROUNDS = 3, 16


def digests(text):
    """Distinct 64-bit digests of a text's paragraphs."""
    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _check(digest):
    return F.xxhash64(digest, F.lit(1))


def _zero():
    return F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("c"))


def _add(cell, digest, check, n):
    return F.struct((cell["n"] + n).alias("n"), cell["x"].bitwiseXOR(digest).alias("x"), cell["c"].bitwiseXOR(check).alias("c"))


def _cell_mask(digest, cells):
    """The digest's three cells as bits of a number (cells of all tables end to end)."""
    bits = cells.bit_length() - 1
    mask = F.lit(0).cast("bigint")
    for t in range(TABLES):
        slot = F.shiftrightunsigned(digest, t * bits).bitwiseAND(F.lit(cells - 1)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), slot + t * cells))
    return mask


def _once(value, use):
    """``use`` of a value computed once. In a lambda a column stands for its
    expression, which is evaluated again for every element; a lambda's own
    argument is not."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sketch(items, cells: int):
    """Cells of an array of structs (d: digest, c: check, m: cell bits, n: 1, or
    -1 for what is to be subtracted)."""
    return _once(items, lambda given: F.transform(
        F.sequence(F.lit(0), F.lit(TABLES * cells - 1)),
        lambda i: F.aggregate(given, _zero(), lambda acc, x: F.when(
            F.getbit(x["m"], i) == 1, _add(acc, x["d"], x["c"], x["n"])).otherwise(acc))))


def _item(digest, n, cells: int):
    return F.struct(digest.alias("d"), _check(digest).alias("c"), _cell_mask(digest, cells).alias("m"), n.alias("n"))


def _prepared(array, cells: int):
    return F.transform(array, lambda d: _item(d, F.lit(1), cells))


def subtract(a, b):
    return F.zip_with(a, b, lambda x, y: F.struct(
        (x["n"] - y["n"]).alias("n"), x["x"].bitwiseXOR(y["x"]).alias("x"), x["c"].bitwiseXOR(y["c"]).alias("c")))


def peel(cells_array, cells: int):
    """Struct (cells, plus, minus): what is left of the cells, and how many
    digests only the first or only the second version has."""
    def pure(state):
        return F.transform(F.array_distinct(F.transform(
            F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["c"] == _check(c["x"]))),
            lambda c: F.struct(c["x"].alias("d"), c["n"].alias("n")))), lambda r: _item(r["d"], r["n"], cells))

    def step(state, _):
        # the round's digests are computed once and used by every cell
        return F.when(state["done"], state).otherwise(F.aggregate(F.array(pure(state)), state, lambda st, found: F.struct(
            F.transform(st["cells"], lambda c, i: F.aggregate(found, c, lambda acc, r: F.when(
                F.getbit(r["m"], i) == 1, _add(acc, r["d"], r["c"], -r["n"])).otherwise(acc))).alias("cells"),
            (st["plus"] + F.size(F.filter(found, lambda r: r["n"] == 1))).alias("plus"),
            (st["minus"] + F.size(F.filter(found, lambda r: r["n"] == -1))).alias("minus"),
            (F.size(found) == 0).alias("done"))))
    start = F.struct(cells_array.alias("cells"), F.lit(0).alias("plus"), F.lit(0).alias("minus"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _emptied(state):
    return F.forall(state["cells"], lambda c: (c["n"] == 0) & (c["x"] == 0) & (c["c"] == 0))


def _outcome(cells_array, cells: int):
    """Struct (ok, plus, minus) of peeling."""
    return F.element_at(F.transform(F.array(peel(cells_array, cells)), lambda st: F.struct(
        _emptied(st).alias("ok"), st["plus"].alias("plus"), st["minus"].alias("minus"))), 1)


def _failed():
    return F.struct(F.lit(False).alias("ok"), F.lit(0).alias("plus"), F.lit(0).alias("minus"))


def _blocks(a, b, count):
    """The digests of both sides by block, each block an array of structs (k:
    block, s: side, d: digest): one sort by block, then a slice per block, so
    the work follows the number of digests. Blocks without digests are left out."""
    def marked(array, side):
        return F.transform(array, lambda d: F.struct(
            F.pmod(F.shiftrightunsigned(d, 24), count).cast("int").alias("k"), F.lit(side).alias("s"), d.alias("d")))

    def starts(rows):
        return F.filter(F.sequence(F.lit(0), F.size(rows) - 1),
                        lambda i: (i == 0) | (F.get(rows, i)["k"] != F.get(rows, i - 1)["k"]))

    def cut(rows, at):
        return F.transform(at, lambda start, i: F.slice(
            rows, start + 1, F.coalesce(F.get(at, i + 1), F.size(rows)) - start))
    # one-element arrays give the sorted digests and the starts a name inside the lambdas
    rows = F.sort_array(F.concat(marked(a, 0), marked(b, 1)))
    return F.flatten(F.transform(F.array(rows), lambda r: F.flatten(F.transform(F.array(starts(r)), lambda at: cut(r, at)))))


def _block_outcome(part):
    """Outcome for the digests of one block (of ``_blocks``): a small sketch, the
    second side's digests subtracted, on failure larger ones in which the digests
    meet other cells."""
    def attempt(cells, mixed):
        signed = F.transform(part, lambda x: F.struct(mixed(x["d"]).alias("d"), (1 - 2 * x["s"]).alias("n")))
        return _outcome(sketch(F.transform(signed, lambda x: _item(x["d"], x["n"], cells)), cells), cells)
    return F.aggregate(F.sequence(F.lit(0), F.lit(RETRIES)), _failed(), lambda st, level: F.when(st["ok"], st).when(
        level == 0, attempt(BLOCK_CELLS, lambda d: d)).otherwise(
        attempt(LARGER_CELLS, lambda d: F.xxhash64(d, level))))


def with_likeness(rows: DataFrame, a: str, b: str, first_a: str, first_b: str, out: str) -> DataFrame:
    """``rows`` with the likeness of two columns of digests (shared over all
    distinct paragraphs, 1.0 for two empty texts), given their first sketches."""
    # the first sketches cannot hold more differences than they have cells
    hopeless = F.abs(F.size(a) - F.size(b)) > TABLES * FIRST_CELLS
    small = F.when(hopeless, _failed()).otherwise(_outcome(subtract(F.col(first_a), F.col(first_b)), FIRST_CELLS))
    # digests in blocks of a bounded number on average, so the work grows with the paragraphs
    count = F.greatest(F.lit(1), F.ceil((F.size(a) + F.size(b)) / BLOCK_LOAD)).cast("int")
    rows = rows.withColumns({"__small": small, "__count": count})
    rows = rows.withColumn("__parts", F.when(~F.col("__small")["ok"], _blocks(F.col(a), F.col(b), F.col("__count"))).otherwise(F.array()))
    rows = rows.withColumn("__solved", F.transform("__parts", _block_outcome))
    ok = F.col("__small")["ok"] | F.forall("__solved", lambda x: x["ok"])
    plus = F.when(F.col("__small")["ok"], F.col("__small")["plus"]).otherwise(
        F.aggregate("__solved", F.lit(0), lambda n, x: n + x["plus"]))
    # if every size failed (digests that agree in all cells), the sets are compared
    shared = F.when(ok, F.size(a) - plus).otherwise(F.size(F.array_intersect(a, b)))
    rows = rows.withColumn("__shared", shared)
    every = F.size(a) + F.size(b) - F.col("__shared")
    return rows.withColumn(out, F.when(every == 0, F.lit(1.0)).otherwise(F.col("__shared") / every).cast("double")).drop(
        "__small", "__count", "__parts", "__solved", "__shared")


def _as_text(text, items, first):
    cells = F.array_join(F.transform(first, lambda c: F.concat(
        F.lower(F.hex(c["n"].cast("bigint"))), F.lit("."), F.lower(F.hex(c["x"])), F.lit("."),
        F.lower(F.hex(c["c"].bitwiseAND(F.lit(0xFFFFFFFF)))))), "-")
    return F.concat(F.size(items).cast("string"), F.lit(":"), F.lower(F.hex(F.xxhash64(text))), F.lit(":"), cells)


def with_next(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text (null as empty) and next_text: the text of the next row in
    descending doc_id, after the last of the first."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body = text_col(docs, text)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("text"),
                       F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))).alias("__at"))
    # at most one bound per task; a bound that comes n times is a doc_id with the rows of n ranges
    cuts = rows.agg(F.percentile_approx("__at", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0] or []
    bounds = sorted(Counter(cuts).items())
    shares = [1, *(n for _, n in bounds)]
    first = list(itertools.accumulate(shares, initial=0))
    low = F.col("__low")
    hashed = rows.withColumn("__hash", F.xxhash64("text")).withColumn(
        "__low", F.size(F.filter(F.lit([float(c) for c, _ in bounds]).cast("array<double>"), lambda c: c <= F.col("__at"))))
    spread = F.least(F.floor((F.col("__hash").cast("double") / 2.0 ** 64 + 0.5) * (F.get(F.lit(shares), low) - 1)),
                     F.get(F.lit(shares), low) - 2)
    on_bound = (F.get(F.lit(shares), low) > 1) & (F.get(F.lit([float("nan"), *(float(c) for c, _ in bounds)]), low) == F.col("__at"))
    ranged = hashed.withColumn("__range", (F.get(F.lit(first), low) + F.when(on_bound, spread).otherwise(
        F.get(F.lit(shares), low) - 1)).cast("int")).drop("__low", "__at")
    order = [F.col("doc_id").desc_nulls_last(), F.col("__hash").desc(), F.col("text").desc()]
    within = Window.partitionBy("__range").orderBy(*order)
    # the first row of each range: one key per range, then its text
    top = ranged.groupBy("__range").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "__hash")).alias("top"))
    links = top.select("__range", "top.doc_id", "top.__hash")
    down = Window.orderBy(F.col("__range"))
    links = links.select(F.col("__range").alias("__r"), F.lag("__range").over(down).alias("__lower"),
                         F.max("__range").over(Window.partitionBy(F.lit(1))).alias("__last"), "doc_id", "__hash")
    heads = (ranged.alias("x").join(F.broadcast(links.alias("h")), (F.col("x.__range") == F.col("h.__r"))
                                    & F.col("x.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("x.__hash") == F.col("h.__hash")))
             .groupBy(F.col("h.__r").alias("__r")).agg(F.max(F.col("x.text")).alias("__head")))
    # a range's last row is followed by the head of the next lower range, the lowest's by the highest's
    follow = (links.select(F.col("__r").alias("__range"), F.coalesce("__lower", "__last").alias("__from"))
              .join(heads.withColumnRenamed("__r", "__from"), "__from").select("__range", "__head"))
    seen = ranged.withColumn("__next", F.lead("text").over(within))
    return seen.join(follow, "__range").select("doc_id", "text", F.coalesce("__next", "__head").alias("next_text"))


def compare_versions(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text, edited_text, next_text) with fingerprints of the
    text and its edited version and both likenesses."""
    sets = rows.withColumns({"__a": digests(F.col("text")), "__e": digests(F.col("edited_text")), "__n": digests(F.col("next_text"))})
    sets = sets.withColumns({f"__f{k}": sketch(_prepared(F.col(f"__{k}"), FIRST_CELLS), FIRST_CELLS) for k in "aen"})
    sets = with_likeness(sets, "__a", "__e", "__fa", "__fe", "near_edited")
    sets = with_likeness(sets, "__a", "__n", "__fa", "__fn", "near_next")
    return sets.withColumns({
        "fingerprint": _as_text(F.col("text"), F.col("__a"), F.col("__fa")),
        "edited_fingerprint": _as_text(F.col("edited_text"), F.col("__e"), F.col("__fe"))})


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = with_next(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))
    changed = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.left("text", (F.col("n_chars") - changed).cast("int")), F.left("next_text", changed))
    out = compare_versions(rows.withColumn("edited_text", edited))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
                      "fingerprint", "edited_fingerprint", "near_edited", "near_next")
