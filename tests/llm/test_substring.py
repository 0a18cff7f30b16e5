"""Both substring deduplications against plain loops, hot and merge paths included."""

from collections import Counter

import numpy as np
import pytest

from dimweave.llm import packed, substring, suffix
from helpers import DOCS, frame, words


def brute_words(rows, size=35):
    split = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i:i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for (d, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_chunks,chunk", [(None, 4 << 20), (0, 700)])
def test_words(spark, monkeypatch, hot_chunks, chunk):
    df = frame(spark).repartition(5)
    if hot_chunks is not None:
        monkeypatch.setattr(packed, "CHUNK_BYTES", chunk)
    got = substring.remove_repeated_words(df, hot_chunks=hot_chunks)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()), key=repr) == brute_words(DOCS)


def test_word_spans_are_the_removed_runs(spark):
    rows = [(1, "a b c " + " ".join(f"w{i}" for i in range(40)) + " z"), (2, " ".join(f"w{i}" for i in range(40)))]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in substring.remove_repeated_words(frame(spark, rows)).collect()}
    assert got == {1: [(3, 43)], 2: [(0, 40)]}


def brute_bytes(rows, size=100):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        b = (rows[i][1] or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if b[k:k + size] in seen:
                gone[k:k + size] = b"\1" * size
            seen.add(b[k:k + size])
        out.append((rows[i][0], len(b), sum(gone), bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_chunks,array", [(None, 4 << 20), (0, 400), (None, 300)])
def test_bytes(spark, hot_chunks, array):
    got = suffix.remove_later_copies(frame(spark).coalesce(1), hot_chunks=hot_chunks, array_bytes=array)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got.collect()), key=repr) == brute_bytes(DOCS)


def test_empty_tables(spark):
    none = frame(spark, []).repartition(3)
    assert substring.remove_repeated_words(none).count() == 0
    assert suffix.remove_later_copies(none).count() == 0


def test_equal_strings_after_a_prefix_of_nothing():
    # the bytes in front of the two copies are neighbours in byte order
    name, first = suffix.equal_strings([b"aXYZc", b"bXYZd"], 3, 1 << 20)
    assert name[first[0] + 1] == name[first[1] + 1] and len(set(name.tolist())) == 5


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(3)
    for n, letters in ((1, 2), (300, 2), (300, 26), (200, 1)):
        text = rng.integers(97, 97 + letters, n).astype(np.uint8)
        order, _ = suffix.suffix_array(text, 1 << 10)
        raw = text.tobytes()
        assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
        shared = suffix.common_prefixes(text, order)
        for k in range(1, n):
            a, b = raw[order[k - 1]:], raw[order[k]:]
            assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_minimisers_meet():
    """Equal windows have equal minimisers, and the runs hold every window once."""
    rng = np.random.default_rng(1)
    for _ in range(60):
        sizes = rng.integers(0, 30, 4)
        first = np.concatenate([[0], np.cumsum(sizes)])
        units = rng.integers(0, 3, first[-1]).astype(np.uint64)
        w = packed.Windows(packed.roll(units, 3), first, 8, 3)
        starts = [i for a, b in zip(first[:-1], first[1:]) for i in range(a, b - 7)]
        assert sorted(i for s, c in zip(w.start, w.count) for i in range(s, s + c)) == starts
        key = {i: k for s, c, k in zip(w.start, w.count, w.key) for i in range(s, s + c)}
        of = {}
        for i in starts:
            assert of.setdefault(tuple(units[i:i + 8]), key[i]) == key[i]


def test_squeeze_round_trip():
    arrays = [np.arange(9, dtype=np.uint64) ** 7, np.zeros(0, np.uint8), np.array([1.5, -2])]
    for a, b in zip(arrays, packed.unsqueeze(packed.squeeze(*arrays))):
        assert a.dtype == b.dtype and (a == b).all()
