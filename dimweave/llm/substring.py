"""Substring deduplication by super-k-mers of words.

A window is ``size`` consecutive words of one document.  Consecutive windows that share a
minimiser travel as one packed string (the words joined by one space) to the shard of that
minimiser, where sorting brings equal windows together and counts them; equal hashes are
checked word for word.  Equal windows have equal minimisers, so they meet.

Only runs whose minimiser occurs more than once travel (a hash count over all chunks finds
them).  Equal strings of a chunk are sent once, with a list of places.  The windows of a hot
minimiser, which very many chunks hold, travel one by one to the shards of their own hashes, so
that no shard gathers all texts around a common passage.

Every word that a repeated window covers goes, in all its copies.

Cases: null and empty texts have no words; a text with fewer words than a window keeps them
all; repeated rows and repeated ids are documents like any other (and so copies of each other);
an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dimweave.llm import packed
from dimweave.llm.packed import Chunk, Pieces, Windows, covered, runs
from dimweave.llm.words import Words, ranges, words_of

SIZE, GRAM = 35, 8
#: Bytes of corpus for each shard; what travels is a small part of it.
SHARD_BYTES = 8 << 20
OUT = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:long,end:long>>"


def joined(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the chosen words, one space after each, and each word's size with it."""
    sizes = words.end[which] - words.start[which] + 1
    source = np.append(words.buffer, np.uint8(0x20))
    out = source[ranges(words.start[which], sizes)]
    out[np.cumsum(sizes) - 1] = 0x20
    return out, sizes


def _windows(size: int, gram: int):
    def of(chunk: Chunk) -> tuple[Words, np.ndarray, Windows]:
        words = words_of(chunk.buffer, chunk.bounds)
        h = words.hashes()
        return words, h, Windows(packed.roll(h, gram), words.first, size, gram)

    return of


def _send(size: int, gram: int, buckets: int, shards: int):
    def run(chunk: Chunk, got: list[tuple[int, bytes]]) -> pa.Table:
        words, h, w = _windows(size, gram)(chunk)
        keys, _ = w.minimisers()
        flags = packed.flagged(keys, got, buckets)[np.searchsorted(keys, w.key)] if len(keys) else np.zeros(0, np.uint8)
        start, count, key = w.start[flags == 1], w.count[flags == 1], w.key[flags == 1]
        if (flags == 2).any():
            one = ranges(w.start[flags == 2], w.count[flags == 2])
            start, count = np.concatenate([start, one]), np.concatenate([count, np.ones(len(one), np.int64)])
            key = np.concatenate([key, packed.roll(h, size)[one]])
        order = np.argsort(key, kind="stable")
        start, count, key = start[order], count[order], key[order]
        out = []
        for shard, a, b in packed.by_bucket(key, shards):
            n = count[a:b] + size - 1
            raw, sizes = joined(words, ranges(start[a:b], n))
            ends = np.cumsum(n)
            own = np.diff(np.concatenate([[0], np.cumsum(sizes)[ends - 1]]))
            text = words.text[start[a:b]]
            out.append({"bucket": shard, "chunk": chunk.name, "blob": Pieces.blob(
                raw, own, text.astype(np.int32), start[a:b] - words.first[text])})
        return pa.Table.from_pylist(out, packed.BLOB_SCHEMA)

    return run


def repeated_windows(pieces: Pieces, size: int) -> tuple[Words, np.ndarray]:
    """The distinct strings' words, and which begin a window that occurs more than once."""
    raw = b"".join(pieces.texts)
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces.texts), np.int64, len(pieces.texts)))])
    words = words_of(np.frombuffer(raw, np.uint8), bounds)
    n = np.diff(words.first) - size + 1
    at = ranges(words.first[:-1], n)
    key = packed.roll(words.hashes(), size)[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    lead = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    twice = np.zeros(len(words.start), bool)
    rest = np.flatnonzero(~new)
    # equal hashes: the same words?
    first, last = words.start, words.end
    a, b = at[lead[group[rest]]], at[rest]
    last_a, last_b = last[a + size - 1].tolist(), last[b + size - 1].tolist()
    same = np.array([raw[p:q] == raw[r:s] for p, q, r, s in zip(first[a].tolist(), last_a, first[b].tolist(), last_b)], bool)
    twice[a[same]] = True
    twice[b[same]] = True
    for g in np.unique(group[rest[~same]]).tolist():  # a hash that two sequences share
        of: dict[bytes, list[int]] = {}
        for i in at[group == g].tolist():
            of.setdefault(raw[first[i]:last[i + size - 1]], []).append(i)
        twice[at[group == g]] = False
        for own in of.values():
            twice[own] = len(own) > 1
    more = np.flatnonzero(pieces.times > 1)
    twice[ranges(words.first[more], n[more])] = True
    return words, twice


def _count(size: int):
    def run(_: int, blobs: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        pieces = Pieces(blobs)
        text, begin = pieces.columns
        words, twice = repeated_windows(pieces, size)
        hit = np.flatnonzero(twice)
        piece, lo, hi = runs(covered(len(words.start), hit, hit + size), words.first)
        lo, hi = lo - words.first[piece], hi - words.first[piece]
        # every occurrence of a piece has the piece's intervals
        order = np.argsort(pieces.piece, kind="stable")
        begins = np.searchsorted(pieces.piece[order], np.arange(len(pieces.texts) + 1))
        times = np.diff(begins)[piece]
        occurrence = order[ranges(begins[piece], times)]
        yield from packed.answer_intervals(pieces, text, begin, occurrence, np.repeat(lo, times), np.repeat(hi, times))

    return run


def _finish(chunk: Chunk, got: list[tuple[int, bytes]]) -> pa.Table:
    words = words_of(chunk.buffer, chunk.bounds)
    text, lo, hi = packed.intervals(got)
    gone = covered(len(words.start), words.first[text] + lo, words.first[text] + hi)
    kept = np.flatnonzero(~gone)
    raw, sizes = joined(words, kept)
    n = np.diff(words.first)
    removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
    # no space after the last word of a text
    ends = np.cumsum(sizes)
    left = n - removed
    last = np.cumsum(left)[left > 0] - 1
    keep = np.ones(len(raw), bool)
    keep[ends[last] - 1] = False
    own = np.zeros(len(n), np.int64)
    own[left > 0] = np.diff(np.concatenate([[0], ends[last]])) - 1
    return pa.table([chunk.doc_ids(), pa.array(n), pa.array(removed), packed.strings(own, raw[keep], pa.string()),
                     packed.span_lists(words.first, gone)], ["doc_id", "n_words", "n_removed", "kept", "spans"])


def remove_repeated_words(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
                          gram: int = GRAM, hot_chunks: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space) and spans (the
    removed runs, as word numbers)."""
    chunks = packed.pack(docs, doc_id=doc_id, text=text)
    total = packed.total_bytes(chunks)
    # a minimiser for each half window of words of about six bytes
    buckets = 1 + total // (3 * (size - gram + 2) * packed.BUCKET_ENTRIES)
    shards = 1 + total // SHARD_BYTES
    windows = _windows(size, gram)
    flags = packed.repeated(chunks, lambda c: windows(c)[2], buckets, hot_chunks)
    sent = packed.with_answers(chunks, flags, _send(size, gram, buckets, shards), packed.BLOB)
    found = packed.in_buckets(sent, _count(size))
    return packed.with_answers(chunks, found, _finish, OUT)
