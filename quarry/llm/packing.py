"""Best-fit packing by bin completion (operator 10).

A document's ids (plus one end id) form a piece of at most ``capacity``
tokens; longer ones are cut from the end into full pieces, so only the first
is shorter. Ids are made in Arrow batches and leave Python as lengths and
checksums only (or as arrays on request).

Which lengths share a sequence depends on lengths alone, so the search runs on
the length histogram: at most ``capacity`` rows whatever the corpus (that bound
is why it may be collected). Each step takes the largest remaining length,
enumerates the undominated fillings of the space beside it in order of waste
and uses the chosen one as often as its lengths last, which empties at least
one length; a second search also uses wasteful ones fewer times. Best-fit
decreasing is the first incumbent; branches whose waste so far already rules
out fewer sequences than the incumbent are cut, and a search ends at the lower
bound (dual feasible functions) or at its node budget (then the incumbent stands: a valid packing,
maybe not the fewest).

Pieces are numbered within their length from counts per (task, length), so a
length that a third of all pieces share is spread over all tasks; the number
selects pattern, sequence and offset from the plan by binary search.

Defined cases: null or empty text is one piece holding the end id; repeated
rows are packed each; an empty table gives an empty result; a null doc_id stays
null; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm._shared import bound_arrow_batches, saved, ship_by_value, worker_cache

#: Parts and ids that a worker keeps before it starts anew, and places (a power of two) to find parts by hash.
CACHE_PARTS, CACHE_IDS, CACHE_PLACES = 1_000_000, 6_000_000, 1 << 21
#: Parts handed to the library at once.
ENCODE_PARTS = 256
#: Fillings compared for one largest length, and branches overall.
FILLINGS, SEARCH_NODES = 4, 6_000
#: Branches of the second search, with wasteful fillings fewer times.
FEWER_NODES = 6_000
#: Parts into which the lower bound cuts the capacity.
DUAL_PARTS = 12


class IdEncoder:
    """Ids of a byte-level BPE, every distinct part of a batch encoded once.

    The library cuts a text by its pattern before it merges, so a text may be
    split before encoding wherever the pattern surely cuts: before white space
    after a visible character, before the last of several white characters (and
    after it, unless it is a space) if a visible one follows, and between an
    ASCII letter and another visible ASCII character (only before an apostrophe,
    not after it). Texts with white space outside ASCII or special strings are
    split at single spaces only (``odd``). Parts go to the library many at a
    time: those with a leading space one after the other, as only a part's first
    id starts with the space, others after a line break each, which is an id of
    its own."""

    def __init__(self, path: str):
        import re

        import numpy as np
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        size = self.model.get_vocab_size()
        self.spaced = np.array([(self.model.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        line = self.model.encode("\n", add_special_tokens=False).ids
        self.line = np.arange(size) == (line[0] if len(line) == 1 else -1)
        self.odd = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
        self.boundary = re.compile(r"(?<=\S) (?=\S)")
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        #: per byte: white, ASCII letter, other visible ASCII, may begin an odd character
        self.white, self.letter, self.mark, self.doubt = np.zeros((4, 256), dtype=bool)
        self.white[[32, *range(9, 14)]] = True
        self.letter[[*range(65, 91), *range(97, 123)]] = True
        self.mark[33:127] = ~self.letter[33:127]
        self.doubt[[*range(0x1c, 0x20), 0xc2, 0xe1, 0xe2, 0xe3]] = True
        self._clear()

    def _clear(self) -> None:
        """No part is known. A place holds the last part learned there: its hash and number."""
        import numpy as np
        self.known = 0
        self.hash_at, self.number_at = np.zeros(CACHE_PLACES, np.uint64), np.full(CACHE_PLACES, -1, np.int32)
        self.flat, self.starts = np.zeros(1 << 16, np.uint32), np.zeros((1 << 14) + 1, np.int64)

    def direct(self, text: str) -> bytes:
        """Parts at single spaces, each encoded by the library as it stands."""
        import numpy as np
        parts = self.boundary.split(text)
        made = self.model.encode_batch_fast(parts[:1] + [" " + p for p in parts[1:]], add_special_tokens=False)
        return b"".join(np.array(e.ids, dtype="<u4").tobytes() for e in made)

    def _learn(self, parts: list[bytes], begins) -> None:
        """Keep the ids of parts under the next numbers. ``begins``: per id, whether
        a part begins with it (``spaced``) or after it (``line``); None: one by one."""
        import numpy as np
        for at in range(0, len(parts), ENCODE_PARTS):
            group = parts[at:at + ENCODE_PARTS]
            size = None
            if begins is not None:
                after = begins is self.line
                text = (b"\n" + b"\n".join(group) if after else b"".join(group)).decode()
                ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
                first = begins[ids]
                if first.sum() == len(group):
                    size = np.diff(np.append(np.flatnonzero(first), len(ids))) - after
                    ids = ids[~first] if after else ids
            if size is None:  # white space, or a model without such ids
                each = [e.ids for e in self.model.encode_batch_fast([p.decode() for p in group], add_special_tokens=False)]
                ids, size = np.array([i for x in each for i in x], dtype=np.uint32), np.array([len(x) for x in each])
            known, top = self.known, int(self.starts[self.known])
            while top + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
            while known + len(group) + 1 > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros(len(self.starts), np.int64)])
            self.flat[top:top + len(ids)] = ids
            self.starts[known + 1:known + len(group) + 1] = top + np.cumsum(size)
            self.known += len(group)

    def encode(self, column) -> list[bytes]:
        """Ids of each text of an Arrow array, as little-endian 32-bit bytes."""
        import numpy as np
        from quarry.llm import _bytes as b
        data, offsets = b.text_bytes(column)
        out: list[bytes] = []
        for lo, hi in b.chunks(offsets):
            out += self._encode(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], np, b)
        return out

    def _not_plain(self, data, whole: bytes, offsets, np) -> list[int]:
        """Numbers of the texts with odd white space or special strings."""
        special = [s.encode() for s in self.special if s.encode() in whole]
        if special:
            doubt = range(len(offsets) - 1)
        else:
            doubt = np.unique(np.searchsorted(offsets, np.flatnonzero(self.doubt[data]), side="right") - 1).tolist()
        texts = ((i, whole[offsets[i]:offsets[i + 1]]) for i in doubt)
        return [i for i, t in texts if any(s in t for s in special) or self.odd.search(t.decode())]

    def _encode(self, data, offsets, np, b) -> list[bytes]:
        import pyarrow as pa
        n = len(data)
        if n == 0:
            return [b""] * (len(offsets) - 1)
        whole = data.tobytes()
        white, letter, mark = self.white[data], self.letter[data], self.mark[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        cut = edge.copy()
        before, here, inside = white[:-1], white[1:], ~edge[1:n]
        cut[1:n] |= here & ~before
        last = before & ~here & inside  # white, and a visible one follows in the text
        cut[:n - 1] |= last
        cut[1:n] |= last & (data[:-1] != 32)
        cut[1:n] |= letter[:-1] & mark[1:] | mark[:-1] & letter[1:] & (data[:-1] != 39)
        start = np.flatnonzero(cut[:n])
        end = np.append(start[1:], n)
        hashed = b.span_hash(b.prefix_hash(data), start, end)
        odd = self._not_plain(data, whole, offsets, np)
        if odd:
            plain = np.ones(len(offsets) - 1, dtype=bool)
            plain[odd] = False
            keep = np.repeat(plain, np.diff(b.per_text(start, offsets)))
            start, end, hashed = start[keep], end[keep], hashed[keep]
        distinct = pa.array(hashed).dictionary_encode()
        inverse = distinct.indices.to_numpy()
        hashed = distinct.dictionary.to_numpy()
        if self.known > CACHE_PARTS or self.starts[self.known] > CACHE_IDS:
            self._clear()
        place = hashed & np.uint64(CACHE_PLACES - 1)
        number = np.where(self.hash_at[place] == hashed, self.number_at[place], -1)
        new = np.flatnonzero(number < 0)
        if len(new):
            where = np.zeros(len(hashed), dtype=np.int64)
            where[inverse] = np.arange(len(inverse))
            s, e = start[where[new]], end[where[new]]
            only_white, spaced = white[e - 1], white[s]
            for chosen, begins in ((spaced & ~only_white, self.spaced), (~spaced, self.line), (only_white, None)):
                number[new[chosen]] = np.arange(self.known, self.known + np.count_nonzero(chosen))
                self._learn([whole[i:j] for i, j in zip(s[chosen].tolist(), e[chosen].tolist(), strict=True)], begins)
            self.hash_at[place[new]], self.number_at[place[new]] = hashed[new], number[new]
        number = number[inverse]
        at = self.starts[number]
        size = self.starts[number + 1] - at
        ends = np.cumsum(size)
        flat = self.flat[np.repeat(at - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        made = flat.astype("<u4", copy=False).tobytes()
        bounds = (4 * np.concatenate([[0], ends])[b.per_text(start, offsets)]).tolist()
        out = [made[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in odd:
            out[i] = self.direct(whole[offsets[i]:offsets[i + 1]].decode())
        return out


def _encoder(path: str) -> IdEncoder:
    kept = worker_cache()
    if ("IdEncoder", path) not in kept:
        kept["IdEncoder", path] = IdEncoder(path)
    return kept["IdEncoder", path]


def cut_into_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0,
                    with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, the task that
    made it (``__task``), its number among that task's pieces of the length
    (``__nth``) and on request the ids."""
    bound_arrow_batches(docs.sparkSession)
    schema = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, __task int, __nth bigint"
              + (", ids array<int>" if with_ids else ""))

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        tail = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for doc, made in zip(ids, _encoder(tokenizer_path).encode(batch.column(1)), strict=True):
                made += tail
                n, view, at, k = len(made) // 4, memoryview(made), 0, 0
                step = n % capacity or capacity
                while at < n:
                    part = view[4 * at:4 * (at + step)]
                    rows.append((doc, k, at, step, zlib.crc32(part), task, seen[step],
                                 np.frombuffer(part, dtype="<i4") if with_ids else None))
                    seen[step] += 1
                    at, k, step = at + step, k + 1, capacity
            cols = list(zip(*rows, strict=True)) or [()] * 8
            arrays = [pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                                                                 pa.int64(), pa.int32(), pa.int64()), strict=False)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "__task", "__nth"]
            if with_ids:
                arrays.append(pa.array(cols[7], type=pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def fillings(space: int, counts: dict[int, int], lengths: list[int], most: int = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated fillings of ``space`` with the lengths at hand (descending
    ``lengths``), least waste first, of large lengths where they can be. One
    length that fills the space exactly dominates every other filling; a filling
    that could still take a length is dominated by the fuller one.

    Which sums of lengths exist is one integer: bit s says that s can be made
    from the lengths so far. The lengths enter from the largest on until the
    whole space can be made; the fillings are read back off the integers."""
    if counts.get(space, 0):
        return [(space,)]
    sums, mask, steps = 1, (1 << (space + 1)) - 1, []
    for n in lengths:
        free = min(counts.get(n, 0), space // n)
        if not free:
            continue
        steps.append((n, free, sums))
        copies = 1  # 1, 2, 4, ... copies at once
        while free:
            take = min(copies, free)
            for_take, at = sums, 0
            # any number up to ``take`` more copies: doublings of the shift
            reach = 1
            while at < take:
                step = min(reach, take - at)
                for_take |= (for_take << (n * step)) & mask
                at += step
                reach *= 2
            sums, free, copies = for_take, free - take, copies * 2
        if sums >> space & 1:
            break
    out: list[tuple[int, ...]] = []
    smallest = next((n for n in reversed(lengths) if counts.get(n, 0)), space + 1)
    total = space
    while total >= 0 and len(out) < most:
        total = (sums & ((1 << (total + 1)) - 1)).bit_length() - 1  # the greatest sum that is left
        chosen, rest = [], total
        for n, free, before in reversed(steps):
            k = 0
            while k < free and not before >> (rest - k * n) & 1:
                k += 1
            chosen += [n] * k
            rest -= k * n
        if rest == 0 and (space - total < smallest or not out):
            out.append(tuple(sorted(chosen, reverse=True)))
        if space - total >= smallest:
            break  # what remains could take a length
        total -= 1
    return out or [()]


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, times) of best-fit decreasing on the histogram: open
    sequences are kept as (room -> patterns with times), and a length goes to
    the smallest room that takes it."""
    import bisect
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(pattern, times, room):
        if room not in open_by_room:
            open_by_room[room] = []
            bisect.insort(rooms, room)
        open_by_room[room].append((pattern, times))

    for n in sorted((n for n in counts if counts[n]), reverse=True):
        todo = counts[n]
        while todo:
            i = bisect.bisect_left(rooms, n)
            if i < len(rooms):
                room = rooms[i]
                pattern, times = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(i)
                used = min(times, todo)
                if times > used:
                    put(pattern, times - used, room)
                put(pattern + (n,), used, room - n)
                todo -= used
            else:
                per = capacity // n
                whole = todo // per
                if whole:
                    put((n,) * per, whole, capacity - n * per)
                if todo % per:
                    put((n,) * (todo % per), 1, capacity - n * (todo % per))
                todo = 0
    return [x for xs in open_by_room.values() for x in xs]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any plan needs: the greatest of bounds by dual feasible
    functions. Lengths below a least one count nothing and those that leave no
    room for it a whole sequence (L2 of Martello and Toth); then a length of more
    than 1/(k+1) of the capacity weighs as many k-th parts as it has whole (k+1)-th
    parts (Fekete and Schepers), k = 0 standing for the length itself."""
    import numpy as np
    total = sum(counts.values())
    if not total:
        return 0
    n = np.array(sorted(counts), dtype=np.int64)
    c = np.array([counts[x] for x in n.tolist()], dtype=np.int64)
    best = -(-int((n * c).sum()) // capacity)
    for least in [0, *n[2 * n <= capacity].tolist()]:
        x = np.where(n > capacity - least, capacity, np.where(n < least, 0, n))
        best = max(best, -(-int((x * c).sum()) // capacity))
        for k in range(1, DUAL_PARTS + 1):
            parts = (k + 1) * x
            # whole parts; a length that is a multiple of the part counts as itself
            exact = parts % capacity == 0
            weight = np.where(exact, k * x, parts // capacity * capacity)  # in units of 1 / (k * capacity)
            best = max(best, -(-int((weight * c).sum()) // (k * capacity)))
    return best


def plan_patterns(counts: dict[int, int], capacity: int, search_nodes: int = SEARCH_NODES
                  ) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in a sequence, number of such sequences) that use every
    length of the histogram exactly as often as it occurs. The first search
    takes each filling as often as its lengths last; where it ends above the
    lower bound, a second one with a budget of its own also takes wasteful
    fillings fewer times."""
    counts = {int(n): int(c) for n, c in counts.items() if c}
    least = lower_bound(counts, capacity)
    incumbent = best_fit_decreasing(counts, capacity)
    incumbent = _search(counts, capacity, least, incumbent, search_nodes, False)
    return _search(counts, capacity, least, incumbent, FEWER_NODES, True)


def _search(counts: dict[int, int], capacity: int, least: int, incumbent: list, nodes: int, fewer: bool
            ) -> list[tuple[tuple[int, ...], int]]:
    """The incumbent, or a plan of fewer sequences found within ``nodes`` branches."""
    total = sum(n * c for n, c in counts.items())
    fewest = sum(t for _, t in incumbent)
    lengths = sorted(counts, reverse=True)
    left, chosen = dict(counts), []
    #: a frame: fillings still to try, the one in use, waste before it
    frames: list[list] = []
    used = waste = 0

    def largest():
        return next((n for n in lengths if left[n]), None)

    def open_frame():
        n = largest()
        left[n] -= 1
        options = fillings(capacity - n, left, [x for x in lengths if x <= capacity - n])
        left[n] += 1
        frames.append([iter(choices([(n, *o) for o in options])), None, waste, used])

    def choices(patterns):
        """(pattern, times): as often as the lengths last, then half as often and so on down to once."""
        most = [(p, min(left[n] // p.count(n) for n in set(p))) for p in patterns]
        yield from most
        for p, times in most if fewer else ():
            while sum(p) < capacity and times > 1:
                times //= 2
                yield p, times

    if fewest > least and counts:
        open_frame()
    while frames and fewest > least and nodes > 0:
        options, current, waste0, used0 = frames[-1]
        if current is not None:
            pattern, times = current
            for n in pattern:
                left[n] += times
            chosen.pop()
            frames[-1][1] = None
        waste, used = waste0, used0
        choice = next(options, None)
        if choice is None:
            frames.pop()
            continue
        nodes -= 1
        pattern, times = choice
        spare = capacity - sum(pattern)
        for n in pattern:
            left[n] -= times
        waste, used = waste0 + spare * times, used0 + times
        frames[-1][1] = (pattern, times)
        chosen.append((pattern, times))
        if largest() is None:
            if used < fewest:
                fewest, incumbent = used, list(chosen)
            continue
        if waste > (fewest - 1) * capacity - total:
            continue  # cannot beat the incumbent: undo and try the next filling
        open_frame()
    return incumbent


def plan_rows(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, copies in a sequence, first sequence, first offset):
    the pieces of a length with ranks from there on go to these places."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in patterns:
        offset, done = 0, {}
        for n in pattern:
            done[n] = done.get(n, 0) + 1
        for n, copies in done.items():
            rows.append((n, taken.get(n, 0), copies, sequence, offset))
            taken[n] = taken.get(n, 0) + copies * times
            offset += n * copies
        sequence += times
    return sorted(rows)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
         with_ids: bool = False) -> DataFrame:
    """Pieces with sequence_id and offset; runs a job for the pieces (kept in the
    shared checkpoint folder) and one for the histogram."""
    pieces = saved(cut_into_pieces(docs, tokenizer_path, capacity, end_id, with_ids))
    per_task = pieces.groupBy("__task", "length").agg(F.count(F.lit(1)).alias("__n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    rows = plan_rows(plan_patterns(counts, capacity))
    ahead = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("__task", "length", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"))
    ranked = pieces.join(before, ["__task", "length"]).withColumn("__rank", F.col("__before") + F.col("__nth"))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    schema = ", ".join(f"{n} {t}" for n, t in ranked.select(*keep).dtypes) + ", sequence_id bigint, offset bigint"

    def place(batches):
        import numpy as np
        import pyarrow as pa
        plan = np.array(rows, dtype=np.int64).reshape(-1, 5)
        starts = (plan[:, 0] << 48) + plan[:, 1]
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length = cols["length"].to_numpy(zero_copy_only=False).astype(np.int64)
            rank = cols["__rank"].to_numpy(zero_copy_only=False).astype(np.int64)
            row = plan[np.searchsorted(starts, (length << 48) + rank, side="right") - 1]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [cols[n] for n in keep] + [pa.array(row[:, 3] + nth // np.maximum(row[:, 2], 1)),
                                           pa.array(row[:, 4] + nth % np.maximum(row[:, 2], 1) * length)],
                names=[*keep, "sequence_id", "offset"])
    return ranked.select(*keep, "__rank").mapInArrow(place, schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048)


ship_by_value(__name__)
