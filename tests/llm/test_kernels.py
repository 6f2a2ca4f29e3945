"""Array kernels and searches of the llm operators against brute force, without Spark."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from quarry.llm import _bytes, packing, quality_model, rule_cascade, simhash_dedup, suffix_dedup, token_counts

ODD = ["", " ", "a", "a ", " a", "a  b", "a\tb", "a \n b\n\n c", "▁x ▁ y", "<s> a </s> b", "x　y", "a   b    c",
       "\x00a b", "é è ö", "<unk> k", "it's we'll 'S a'll", "\n", "\n\n a", "x\xa0 y", "a." * 40, "a\r\nb", "日本 語。 x.",
       "<|endoftext|> a <|endoftext|>", "a<|endoftext|> b", "w.\n\nNext, one.\nTwo . three ,four", " " * 30, "a " * 3000 + "z"]


def test_spans_hash_alike_wherever_they_stand():
    data = np.frombuffer(b"abc xyz abc xyzabc", np.uint8)
    h = _bytes.span_hash(_bytes.prefix_hash(data), np.array([0, 8, 15, 4]), np.array([3, 11, 18, 7]))
    assert h[0] == h[1] == h[2] != h[3]


def test_text_bytes_of_slices_and_nulls():
    data, off = _bytes.text_bytes(pa.array(["xx", "ab", None, "é"])[1:])
    assert data.tobytes() == "abé".encode() and off.tolist() == [0, 2, 2, 4]
    assert _bytes.text_bytes(pa.array([], pa.string()))[1].tolist() == [0]


def brute_features(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    covered = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 8)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "n_same_words": sum(a == b for a, b in zip(words, words[1:]))}


def random_texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "é", "##", "|", "word", "a", "\x0bz", "x\x00"]
    gaps = [" ", " ", " ", "\n", "\t", "  ", "\n\n", "\r"]
    return ["".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.choice([0, 1, 7, 8, 9, 60]))) for _ in range(n)]


def test_rule_features_match_brute_force():
    texts = random_texts(3, 200) + ODD
    data, off = _bytes.text_bytes(pa.array(texts))
    view = rule_cascade.View(data, off)
    for name in rule_cascade.FEATURES:
        assert view.feature(name).tolist() == [brute_features(t)[name] for t in texts], name
    part = view.take(np.arange(len(texts)) % 3 == 0)
    fresh = rule_cascade.View(part.data, part.offsets)
    for name in rule_cascade.FEATURES:
        assert (part.feature(name) == fresh.feature(name)).all()


@pytest.mark.parametrize("texts", [ODD, random_texts(4, 50)])
def test_piece_counts_equal_the_library(texts):
    counter = token_counts.PieceCounter(public_tokenizers.path("piece_bpe_32k.model"))
    assert counter.cuts
    assert counter.count(texts) == [len(x) for x in counter.model.encode(texts)]
    assert counter.count(texts) == [len(x) for x in counter.model.encode(texts)]


@pytest.mark.parametrize("texts", [ODD, random_texts(5, 50)])
def test_ids_equal_the_library(texts):
    encoder = packing.IdEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(pa.array(texts))]
        assert got == [encoder.model.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_equal_the_library_wherever_a_text_is_cut(monkeypatch):
    """Runs of white space, contractions, digits and special strings, with a cache that overflows and without."""
    rng = random.Random(11)
    bits = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "'", "'s", "'ll", "-", ".", ",", "(", "<", "$", "a", "s", "ll", "the", "The",
            "Z", "0", "12", "\u00e9", "\u00df", "\u65e5", "\u0301", "\u201c", "\u00a0", "\x1c", "\u2003", "<|endoftext|>", "<|endo"]
    for cache in ((3, 4, 2), (50, 16, 7), (1000, 64, 256)):
        for name, value in zip(("CACHE_PARTS", "CACHE_PLACES", "ENCODE_PARTS"), cache, strict=True):
            monkeypatch.setattr(packing, name, value)
        encoder = packing.IdEncoder(public_tokenizers.path("byte_bpe_50k.json"))
        for _ in range(8):
            some = rng.sample(bits, rng.randint(3, len(bits)))
            texts = ["".join(rng.choices(some, k=rng.randint(0, 25))) for _ in range(60)] + [None]
            got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(pa.array(texts))]
            assert got == [encoder.model.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_long_parts_do_not_pile_up(monkeypatch):
    """Texts without a space are a part each; the ids kept are bounded, too."""
    monkeypatch.setattr(packing, "CACHE_IDS", 20_000)
    encoder, rng = packing.IdEncoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(13)
    for _ in range(40):
        texts = ["".join(rng.choices("\u65e5\u672c\u8a9e\u4e2d\u6587\u00e9", k=3_000)) for _ in range(2)]
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(pa.array(texts))]
        assert got == [encoder.model.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.flat) <= 1 << 16


class Watched:
    """The library's model, which notes the characters that it is asked for."""

    def __init__(self, model):
        self.model, self.asked = model, 0

    def encode(self, text, **more):
        self.asked += len(text)
        return self.model.encode(text, **more)

    def encode_batch_fast(self, texts, **more):
        self.asked += sum(map(len, texts))
        return self.model.encode_batch_fast(texts, **more)


@pytest.mark.parametrize("around", ["{}\n{}", "({}) {}", "{}: {}", "\"{}\" {}", "{}-{}", "{}  {}", "{}\t{}", "{}7 {}$$$"])
def test_a_known_word_is_not_encoded_again_for_what_stands_around_it(around):
    encoder = packing.IdEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefgh", k=9)) for _ in range(500)]
    encoder.encode(pa.array([" ".join(words), "\n".join(words)]))
    encoder.model = Watched(encoder.model)
    texts = [around.format(a, b) for a, b in zip(words[1:], words[2:])]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(pa.array(texts))]
    assert encoder.model.asked < len("".join(texts)) / 10
    assert got == [encoder.model.encode(t, add_special_tokens=False).ids for t in texts]


def test_many_parts_stay_known():
    """300,000 different words, twice: the second time the library is asked for few."""
    encoder = packing.IdEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = pa.array([" ".join(f"{chr(97 + i % 26)}{i:x}" for i in range(at, at + 10_000)) for at in range(0, 300_000, 10_000)])
    first = encoder.encode(texts)
    encoder.model = Watched(encoder.model)
    assert encoder.encode(texts) == first
    assert encoder.model.asked < sum(map(len, texts.to_pylist())) / 4


def fewest(lengths, capacity):
    """Brute force: least number of sequences by trying every place for every piece."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, rooms[:k] + (rooms[k] - lengths[i],) + rooms[k + 1:])
        place(i + 1, rooms + (capacity - lengths[i],))
    place(0, ())
    return best[0]


def test_patterns_use_every_length_and_reach_the_optimum():
    rng = random.Random(8)
    for _ in range(60):
        capacity = rng.choice([10, 16, 30])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 9))), reverse=True)
        patterns = packing.plan_patterns(Counter(lengths), capacity)
        assert Counter(n for p, t in patterns for n in p * t) == Counter(lengths)
        assert all(sum(p) <= capacity for p, _ in patterns)
        assert sum(t for _, t in patterns) == (fewest(tuple(lengths), capacity) if lengths else 0)


def test_search_improves_on_best_fit():
    counts = Counter([6, 6, 5, 4, 3, 2, 2, 2])
    assert sum(t for _, t in packing.best_fit_decreasing(counts, 10)) == 4
    assert sum(t for _, t in packing.plan_patterns(counts, 10)) == 3


def test_search_takes_wasteful_fillings_fewer_times():
    for capacity, counts, want in ((20, {4: 6, 9: 4, 7: 6, 19: 5, 12: 3}, 12), (12, {2: 6, 6: 6, 7: 3, 8: 5, 11: 3, 3: 6}, 14),
                                   (30, {9: 6, 14: 1, 5: 6, 28: 5, 12: 6, 16: 6}, 14)):
        patterns = packing.plan_patterns(counts, capacity, 300)
        assert Counter(n for p, t in patterns for n in p * t) == Counter(counts) and all(sum(p) <= capacity for p, _ in patterns)
        assert sum(t for _, t in patterns) == want == packing.lower_bound(counts, capacity)


def test_fillings_are_the_fullest_there_are():
    rng = random.Random(1)
    for _ in range(400):
        space, lengths = rng.randrange(1, 40), sorted({rng.randrange(1, 25) for _ in range(rng.randrange(1, 7))}, reverse=True)
        counts = {n: rng.randrange(0, 4) for n in lengths}
        fit = [n for n in lengths if n <= space]
        found, sums = packing.fillings(space, counts, fit), {0}
        for n in [n for n in fit for _ in range(counts[n])]:
            sums |= {s + n for s in sums if s + n <= space}
        assert sum(found[0]) == max(sums) and len(set(found)) == len(found)
        assert all(o.count(n) <= counts[n] for o in found for n in o) and all(sum(o) <= space for o in found)


@pytest.mark.parametrize("low,high,want", [(700, 1100, 1500), (1025, 2048, 3000)])
def test_bound_ends_the_search_for_long_pieces(low, high, want):
    rng = random.Random(2)
    counts = Counter(rng.randrange(low, high) for _ in range(3000))
    patterns = packing.plan_patterns(counts, 2048)
    assert packing.lower_bound(counts, 2048) == want == sum(t for _, t in patterns)


def test_lower_bound_counts_long_pieces():
    assert packing.lower_bound({6: 10}, 10) == 10 and packing.lower_bound({}, 10) == 0
    rng = random.Random(9)
    for _ in range(60):
        capacity = rng.choice([10, 16, 30])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        least = packing.lower_bound(Counter(lengths), capacity)
        assert -(-sum(lengths) // capacity) <= least <= fewest(tuple(lengths), capacity)


def test_plan_rows_place_every_rank():
    rng = random.Random(9)
    counts = Counter(rng.randint(1, 64) for _ in range(500))
    places = Counter()
    for length, first, copies, sequence, offset in packing.plan_rows(packing.plan_patterns(counts, 64)):
        assert length and first >= 0 and copies > 0 and 0 <= offset < 64 and sequence >= 0
        places[length] += 1
    assert set(places) == set(counts)


def test_ngrams_stay_in_their_text():
    texts = ["one two three", "", "four", "one two three"]
    index, bounds = quality_model.ngrams(*_bytes.text_bytes(pa.array(texts)))
    parts = [sorted(index[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    assert parts[0] == parts[3] and len(parts[0]) == 5 and parts[1] == [] and len(parts[2]) == 1


def test_repeats_are_marked():
    index, bounds = quality_model.ngrams(*_bytes.text_bytes(pa.array(["x y z x y z", "a a"])))
    # 6 words, 5 pairs, 2 pairs seen before, 1 triple seen before; 2 words, 1 pair, 1 pair of the same word
    assert np.diff(bounds).tolist() == [6 + 5 + 2 + 1, 2 + 1 + 1]


def test_ftrl_separates():
    rng = np.random.default_rng(1)
    examples, labels = [], []
    for i in range(400):
        label = i % 2
        examples.append((np.unique(np.append(rng.integers(10, 60, 6), label)), None))
        labels.append(float(label))
    examples = [(np.append(i, 1 << 8), np.append(np.full(len(i), 1.0), 1.0)) for i, _ in examples]
    w = quality_model.ftrl(examples, labels, bits=8, epochs=3)
    assert w[1] - w[0] > 1


def brute_fingerprint(text, k=4):
    import xxhash
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_match_brute_force():
    for text in ODD + random_texts(6, 60):
        got = simhash_dedup._fingerprint(text.encode(), 4) & (1 << 64) - 1
        assert got == brute_fingerprint(text), text


@pytest.mark.parametrize("m", [1, 2, 3, 4, 5])
def test_segments_cover_and_radii_suffice(m):
    layout = simhash_dedup._layout(m, 4)
    assert sum(w for _, w, _ in layout) == 64 and sum(r + 1 for _, _, r in layout) == 5


def brute_repeats(runs, starts, length):
    first, out = {}, set()
    for i, r in enumerate(runs):
        for p in range(starts[i]):
            if first.setdefault(r[p:p + length], (i, p)) != (i, p):
                out.add((i, p))
    return out


def test_suffix_kernels_need_little_memory():
    """Two workers stand beside an executor's heap; a call's arrays stay small beside it."""
    import tracemalloc
    rng = np.random.default_rng(3)
    rows = [rng.integers(97, 123, 150, dtype=np.uint8).tobytes() for _ in range(suffix_dedup.SORT_BYTES // 150)]
    doc, ones = np.arange(len(rows)), np.ones(len(rows), np.int64)
    text = rng.integers(97, 123, suffix_dedup.CHUNK_BYTES, dtype=np.uint8)
    calls = [lambda: suffix_dedup.repeats_in_runs(rows, 51 * ones, doc, 0 * ones, 100),
             lambda: suffix_dedup.anchor_runs(text, np.array([0, len(text)]), 100, 16),
             lambda: _bytes.prefix_hash(rng.integers(0, 256, _bytes.CHUNK_BYTES, dtype=np.uint8))]
    for call in calls:
        tracemalloc.start()
        try:
            call()
            assert tracemalloc.get_traced_memory()[1] < 96 << 20
        finally:
            tracemalloc.stop()


def test_two_stage_sort_and_common_prefixes():
    rng = random.Random(5)
    for _ in range(150):
        length = rng.choice([4, 8, 12, 20])
        letters = rng.choice(["ab", "abc", "a", "\x00\xffa"])
        runs = [bytes(ord(rng.choice(letters)) for _ in range(rng.randint(length, length + 15))) for _ in range(rng.randint(1, 12))]
        starts = np.array([len(r) - length + 1 for r in runs])
        no, at, until = suffix_dedup.repeats_in_runs(runs, starts, np.arange(len(runs)), np.zeros(len(runs), int), length)
        got = {(int(n), p) for n, a, u in zip(no, at, until) for p in range(a, u - length + 1)}
        assert got == brute_repeats(runs, starts, length)
        symbols = np.concatenate([np.array([x + 1 for x in r] + [0]) for r in runs])
        wanted = np.array([rng.random() < 0.5 for _ in symbols])
        order = suffix_dedup.two_stage_sort(symbols, wanted, length)
        keys = [tuple(symbols[i:i + length]) for i in order]
        assert keys == sorted(keys) and sorted(order) == np.flatnonzero(wanted).tolist()


def test_anchor_runs_hold_every_start_once():
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"abcd") for _ in range(rng.choice([0, 3, 20, 21, 200]))) for _ in range(30)] + [b"a" * 150]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    no, start, n, anchor, body = suffix_dedup.anchor_runs(np.frombuffer(b"".join(texts), np.uint8), off, 20, 6)
    found = sorted((int(i), int(s + k)) for i, s, c in zip(no, start, n) for k in range(c))
    assert found == [(i, p) for i, t in enumerate(texts) for p in range(len(t) - 19)]
    # equal strings have equal anchors
    by = {}
    for i, s, c, a in zip(no, start, n, anchor):
        for k in range(c):
            assert by.setdefault(texts[i][s + k:s + k + 20], a) == a


def test_cut():
    raw = "añb".encode()
    kept, n, gone, spans = suffix_dedup._cut(raw, [1], [2])
    assert (kept, n, gone, spans) == (raw[:1] + raw[2:], 4, 1, 1)
    assert suffix_dedup._cut(raw, None, None) == (raw, 4, 0, 0)
    assert suffix_dedup._cut(b"0123456789", [0, 2, 7], [3, 5, 8])[1:] == (10, 6, 2)
    assert hashlib.sha256(suffix_dedup._cut(b"0123456789", [0, 2, 7], [3, 5, 8])[0]).hexdigest() == hashlib.sha256(b"5689").hexdigest()


def test_sizes_as_settings_write_them(spark):
    from quarry.llm import _shared
    assert [_shared.size_in_bytes(x) for x in ("-1", "8", "8b", "8m", "1k", "2KB", "1g", "3 MiB")] == [
        -1, 8, 8, 8 << 20, 1 << 10, 2 << 10, 1 << 30, 3 << 20]
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    kept = spark.conf.get(key)
    try:
        for given, want in (("4m", "4m"), ("64m", str(_shared.ARROW_BATCH_BYTES))):
            spark.conf.set(key, given)
            _shared.bound_arrow_batches(spark)
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, kept)
