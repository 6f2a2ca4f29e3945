"""Records of delimited files whose quoted fields hold line breaks, in parallel.

Spark's ``multiLine`` reader takes a whole file in one task, because a line break
ends a record only outside quotes and a split does not know where it begins.
Here files are read as lines, so they split anywhere, and the quoting is settled
over the splits:

1. Every split is scanned once under both assumptions, that it begins outside
   and that it begins inside a quoted field. What it says in the end (inside or
   outside) makes one narrow row per split. Two scans that agree at a line agree
   from there on, so most of a split is scanned once.
2. The driver, which lists the splits anyway, walks these rows file by file:
   now each split's beginning is known.
3. Every split is scanned again and cut into records. Only the record that
   crosses the end of a split travels: its pieces are brought together by the
   split that it began in.

The splits must be the same in both scans. Spark derives them from file sizes,
its settings and, for small inputs, the number of cores; ``spark.sql.files.
minPartitionNum`` is fixed where it is unset, and a split that was not seen
before fails the job instead of giving wrong records.
"""

from __future__ import annotations

import sys
from dataclasses import astuple, dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import fix_splits

OUTSIDE, INSIDE = False, True


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line that begins inside or outside a quoted field ends inside
    one. A quote opens a field only as its first character; in a quoted field
    two quotes are one, and what follows the closing quote is plain."""
    at = 0
    if not inside:
        if line.startswith('"'):
            at, inside = 1, True
        else:
            at = line.find(sep + '"')
            if at < 0:
                return OUTSIDE
            at, inside = at + len(sep) + 1, True
    while True:
        at = line.find('"', at)
        if at < 0:
            return INSIDE
        if line.startswith('"', at + 1):
            at += 2
            continue
        at = line.find(sep + '"', at + 1)
        if at < 0:
            return OUTSIDE
        at += len(sep) + 1


@dataclass
class Split:
    """What one assumption about a split's beginning says: where it stands now,
    the first and the last line that begin a record (-1: none)."""
    inside: bool
    first: int = -1
    last: int = -1

    def begin(self, line: int) -> None:
        if self.first < 0:
            self.first = line
        self.last = line


@dataclass(frozen=True)
class Known:
    """A split as settled: how it begins and ends, the split (its first byte) in
    which the record that stands open at its beginning began, the first and the
    last line that begin a record (-1: none)."""
    lines: int
    inside: bool
    open_from: int
    stays_open: bool
    first: int
    last: int
    windows: bool


@dataclass
class Open:
    """A split that is being walked: lines so far, whether they end inside quotes,
    the lines held back and where they begin."""
    key: tuple[int, int]
    info: Known
    lines: int = 0
    inside: bool = False
    held: list[str] | None = None
    number: int = 0


def _runs(key, block):
    """Ranges of rows of a batch that belong to one split."""
    import numpy as np
    change = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
    edges = [0, *change.tolist(), len(key)]
    return [(a, z) for a, z in zip(edges[:-1], edges[1:], strict=True) if z > a]


def _columns(batch):
    import pyarrow as pa
    value = batch.column(2)
    value = value.combine_chunks() if isinstance(value, pa.ChunkedArray) else value
    return (batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), value)


def _quoted(value) -> list[int]:
    """Numbers of the lines that hold a quote; the others change nothing."""
    import numpy as np
    import pyarrow.compute as pc
    return np.flatnonzero(pc.match_substring(value, '"').to_numpy(zero_copy_only=False)).tolist()


def _both_ways(sep: str):
    """Arrow function (file, block, value) -> one row per split."""
    def run(batches):
        import pyarrow as pa
        names = ["file", "block", "lines", "windows", *[f"{n}{i}" for i in (0, 1) for n in ("inside", "first", "last")]]
        rows, now = [], None

        def close():
            key, lines, ways, windows = now
            rows.append((*key, lines, windows, *[x for w in ways for x in (w.inside, w.first, w.last)]))
        for batch in batches:
            key, block, value = _columns(batch)
            for a, z in _runs(key, block):
                if now is None or now[0] != (int(key[a]), int(block[a])):
                    if now is not None:
                        close()
                    now = [(int(key[a]), int(block[a])), 0, (Split(OUTSIDE), Split(INSIDE)), value[a].as_py().endswith("\r")]
                base, ways = now[1] - a, now[2]
                part = value.slice(a, z - a)
                at = a
                for i in [*[a + q for q in _quoted(part)], z]:
                    # lines at .. i - 1 hold no quote, line i does
                    for w in ways:
                        if not w.inside and i > at:
                            w.begin(base + at)
                            w.last = base + i - 1
                        if i < z and not w.inside:
                            w.begin(base + i)
                    if i < z:
                        line = value[i].as_py()
                        if ways[0].inside == ways[1].inside:
                            ways[0].inside = ways[1].inside = ends_inside(line, ways[0].inside, sep)
                        else:
                            for w in ways:
                                w.inside = ends_inside(line, w.inside, sep)
                    at = i + 1
                now[1] += z - a
        if now is not None:
            close()
        cols = list(zip(*rows, strict=True)) or [()] * len(names)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), *[pa.bool_(), pa.int64(), pa.int64()] * 2]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, kinds, strict=True)], names=names)
    return run


def settle(rows) -> dict[tuple[int, int], Known]:
    """The splits of all files, walked from the first byte of each."""
    out: dict[tuple[int, int], Known] = {}
    file, inside, owner, windows = None, OUTSIDE, 0, False
    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            file, inside, owner, windows = r["file"], OUTSIDE, r["block"], r["windows"]
        way = 1 if inside else 0
        last, ends = r[f"last{way}"], r[f"inside{way}"]
        out[r["file"], r["block"]] = Known(r["lines"], inside, owner, ends, r[f"first{way}"], last, windows)
        owner = r["block"] if last >= 0 else owner
        inside = ends
    return out


class _Splits:
    """Walks Arrow batches split by split; ``sent`` holds the settled splits."""

    def __init__(self, sent):
        self.known, self.now = {k: Known(*v) for k, v in sent.value.items()}, None

    def parts(self, batches):
        """(batch number, split, lines before, lines as an Arrow array)."""
        for no, batch in enumerate(batches):
            key, block, value = _columns(batch)
            for a, z in _runs(key, block):
                here = (int(key[a]), int(block[a]))
                if self.now is None or self.now.key != here:
                    self.check()
                    if here not in self.known:
                        raise RuntimeError("a split was not there in the first scan: set spark.sql.files.minPartitionNum")
                    self.now = Open(here, self.known[here])
                yield no, self.now, self.now.lines, value.slice(a, z - a)
                self.now.lines += z - a
        self.check()

    def check(self):
        if self.now is not None and self.now.lines != self.now.info.lines:
            raise RuntimeError("the splits of the file changed between two scans: set spark.sql.files.minPartitionNum")


def _texts(split, lines) -> list[str]:
    texts = lines.to_pylist()
    return [x[:-1] if x.endswith("\r") else x for x in texts] if split.info.windows else texts


NAMES = ["file", "block", "number", "record"]


def _rows(rows):
    import pyarrow as pa
    cols = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                                      names=NAMES)


def _cut(sep: str, sent):
    """Arrow function that gives the records which begin and end in a split."""
    def run(batches):
        import numpy as np
        out, last_no = [], 0
        walk = _Splits(sent)
        for no, split, before, lines in walk.parts(batches):
            if no != last_no:
                yield _rows(out)
                out, last_no = [], no
            info, n = split.info, len(lines)
            if before == 0:
                split.inside, split.held, split.number = info.inside, [], 0
            # the lines from the split's first record to the one that its end leaves open
            lo = max(info.first, 0) - before if info.first >= 0 else n
            hi = (info.last if info.stays_open else info.lines) - before
            lo, hi = min(max(lo, 0), n), min(max(hi, 0), n)
            if lo >= hi:
                continue
            if before + lo == info.first:
                split.inside = False
            part = lines.slice(lo, hi - lo)
            texts, begins = _texts(split, part), np.zeros(hi - lo, dtype=bool)
            at = 0
            for i in [*_quoted(part), hi - lo]:
                begins[at:i] = not split.inside  # lines without a quote: all go on, or each is a record
                if i < hi - lo:
                    begins[i] = not split.inside
                    split.inside = ends_inside(texts[i], split.inside, sep)
                at = i + 1
            edges = np.flatnonzero(begins).tolist()
            split.held += texts[:edges[0]] if edges else texts
            if edges:
                if split.held:
                    out.append((*split.key, split.number, "\n".join(split.held)))
                out.extend((*split.key, before + lo + a, texts[a] if z == a + 1 else "\n".join(texts[a:z]))
                           for a, z in zip(edges[:-1], edges[1:], strict=True))
                split.held, split.number = texts[edges[-1]:], before + lo + edges[-1]
            if before + hi == (info.last if info.stays_open else info.lines) and split.held:
                out.append((*split.key, split.number, "\n".join(split.held)))
                split.held = []
        yield _rows(out)
    return run


def _pieces(sent):
    """Arrow function that gives the parts of records which cross splits' ends:
    (file, split in which the record began, split of the part, text)."""
    def run(batches):
        walk = _Splits(sent)
        for _, split, before, lines in walk.parts(batches):
            info, n = split.info, len(lines)
            head = min(max((info.first if info.first >= 0 else info.lines) - before, 0), n) if info.inside else 0
            tail = min(max(info.last - before, 0), n) if info.stays_open and info.last >= 0 else n
            if before == 0:
                split.held, split.number = [], 0
            if head:
                split.held += _texts(split, lines.slice(0, head))
            if info.inside and before + n >= (info.first if info.first >= 0 else info.lines) and split.number == 0:
                yield _rows([(split.key[0], info.open_from, split.key[1], "\n".join(split.held))])
                split.held, split.number = [], 1
            if tail < n:
                split.held += _texts(split, lines.slice(tail))
            if info.stays_open and info.last >= 0 and before + n == info.lines:
                yield _rows([(split.key[0], split.key[1], split.key[1], "\n".join(split.held))])
    return run


def file_key(path):
    return F.xxhash64(path)


def scan_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(file, block, piece, number, first, record): the text of every record with its place,
    comparable in file order: the split's first byte, 0 for a record within
    the split and 1 for the one that crosses its end, the line in the split.
    ``first`` marks a file's first record. One job runs here."""
    fix_splits(spark)
    raw = spark.read.option("lineSep", "\n").text(path).select(
        file_key(F.input_file_name()).alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    seen = raw.mapInArrow(_both_ways(sep), "file bigint, block bigint, lines bigint, windows boolean, inside0 boolean, first0 bigint, "
                                           "last0 bigint, inside1 boolean, first1 bigint, last1 bigint").collect()
    known = settle(seen)
    sent = spark.sparkContext.broadcast({k: astuple(s) for k, s in known.items()})  # one entry per split, plain values
    schema = "file bigint, block bigint, number bigint, record string"
    whole = raw.mapInArrow(_cut(sep, sent), schema).select("file", "block", F.lit(0).alias("piece"), "number", "record")
    start: dict[int, int] = {}
    for file, block in known:
        start[file] = min(block, start.get(file, block))
    # only the lines of splits that begin or end inside quotes are looked at again; a file's
    # first record is at line 0 of its first split, within the split or beyond its end
    crossing = [(*k, k[1] == start[k[0]] and s.stays_open and s.last == 0) for k, s in known.items() if s.inside or s.stays_open]
    whole = whole.select("file", "block", "piece", "number", ((F.col("block") == 0) & (F.col("number") == 0)).alias("first"), "record")
    if not crossing:
        return whole
    wanted = F.broadcast(spark.createDataFrame(crossing, "file bigint, block bigint, first boolean"))
    parts = raw.join(wanted, ["file", "block"], "left_semi").select("file", "block", "value").mapInArrow(_pieces(sent), schema)
    joined = parts.groupBy("file", "block").agg(F.array_sort(F.collect_list(F.struct("number", "record"))).alias("parts"))
    joined = joined.join(wanted, ["file", "block"]).select(
        "file", "block", F.lit(1).alias("piece"), F.lit(0).cast("bigint").alias("number"), "first",
        F.array_join(F.col("parts.record"), "\n").alias("record"))
    return whole.unionByName(joined)


def file_names(spark: SparkSession, path: str) -> DataFrame:
    """(file, path): one row per file, as many as the driver lists itself."""
    files = spark.read.text(path).inputFiles()
    return spark.createDataFrame([(f,) for f in files], "path string").select(file_key("path").alias("file"), "path")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
