"""Array kernels over the bytes of a batch of texts (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

from quarry.llm._shared import ship_by_value, worker_cache

#: Bytes of text that one kernel call works on (a longer text is taken alone). The
#: arrays of a call are a hundred times that, and a worker keeps some of the memory.
CHUNK_BYTES = 1 << 19

_MASK = (1 << 64) - 1


def _mixed(i: int) -> int:
    """The i-th number of a splitmix sequence: fixed pseudo-random constants by rule."""
    z = (i * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _MASK
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
    return z ^ (z >> 31)


BYTE_CODE = np.array([_mixed(i) for i in range(256)], dtype=np.uint64)
BASE = _mixed(1000) | 1
BASE_INV = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True

def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**j and BASE**-j modulo 2**64 for j < n."""
    kept = worker_cache()
    have = kept.get("powers")
    if have is None or len(have[0]) < n:
        made = []
        for base in (BASE, BASE_INV):
            steps = np.full(max(n, CHUNK_BYTES + 1024), base, dtype=np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        have = kept["powers"] = tuple(made)
    return have[0][:n], have[1][:n]


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets) of an Arrow string array; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offs, dtype=width)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Ranges [a, b) of texts with at most ``limit`` bytes together."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] = sum of code(data[i]) * BASE**i for i < j, modulo 2**64."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODE[data] * up[:-1], out=out[1:])
    return out


def finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(_mixed(1001) | 1)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(_mixed(1002) | 1)
    return h ^ (h >> np.uint64(32))


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes and length, wherever the span stands."""
    _, down = powers(len(prefix))
    h = (prefix[end] - prefix[start]) * down[start]
    return finish(h + (end - start).astype(np.uint64) * np.uint64(_mixed(1003)))


def runs(wanted: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of true bytes; runs end at text ends."""
    n = len(wanted)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = wanted[:-1]
    start = np.flatnonzero(wanted & (~before | first[:-1]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = wanted[1:]
    end = np.flatnonzero(wanted & (~after | first[1:])) + 1
    return start, end


def per_text(start: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First index of ``start`` in each text, with one more for the end."""
    return np.searchsorted(start, offsets)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive ``bounds`` (empty ranges give 0)."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


ship_by_value(__name__)
