"""Substring deduplication by suffix arrays over bytes.

Every byte goes that a string of ``size`` bytes covers which also starts earlier (in a document
with a smaller id, or earlier in the same one); the first copy stays.

Strings meet by their minimisers: runs of windows whose minimiser occurs more than once travel
to its shard.  A shard builds suffix arrays of its distinct strings by Larsson-Sadakane
refinement (only groups that still tie are sorted again, each time by twice as many bytes), and
common prefixes in text order by Kasai's rule (a suffix shares at least one byte less than the
suffix before it, so only where neighbours change are bytes compared).  Neighbours that share
``size`` bytes begin equal strings.  A shard of more than ``ARRAY_BYTES`` distinct bytes is cut
into several arrays, whose groups are merged by binary search.

Cases: null and empty texts have no bytes; a text shorter than ``size`` stays whole; a null id
comes before all others; rows with the same id are ordered by where they lie, and the later
copy goes; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dimweave.llm import packed
from dimweave.llm.packed import Chunk, Pieces, Windows, covered, runs
from dimweave.llm.words import mix, ranges, words_at

SIZE, GRAM = 100, 32
SHARD_BYTES, ARRAY_BYTES = 8 << 20, 4 << 20
OUT = "doc_id long, n_bytes long, n_removed long, kept binary, spans array<struct<start:long,end:long>>"


# ---------------------------------------------------------------- suffix arrays
def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions in the order of their suffixes' first ``depth`` bytes or more, rank of each
    position): Larsson-Sadakane refinement, ties in ascending position."""
    n = len(text)
    key = words_at(text, big_endian=True)[:n].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)  # places where a group begins
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    starts = np.flatnonzero(new)
    rank[order] = starts[np.cumsum(new) - 1]  # a group's rank is the place where it begins
    known = 8
    while known < depth:
        size = np.diff(np.append(starts, n))
        tied = starts[size > 1]
        if not len(tied):
            break
        place = ranges(tied, size[size > 1])  # only groups that tie are sorted again
        pos = order[place]
        ahead = pos + known
        far = np.full(len(pos), -1, np.int64)  # beyond the end comes first
        inside = ahead < n
        far[inside] = rank[ahead[inside]]
        own = rank[pos]
        by = np.argsort(own * (n + 1) + far + 1, kind="stable")
        pos, own, far = pos[by], own[by], far[by]
        order[place] = pos
        split = np.ones(len(pos), bool)
        split[1:] = (own[1:] != own[:-1]) | (far[1:] != far[:-1])
        begin = place[split]
        rank[pos] = begin[np.cumsum(split) - 1]
        new[begin] = True
        starts = np.flatnonzero(new)
        known *= 2
    return order, rank


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of the suffix array, how many bytes its suffix shares with the one before
    (0 at the first).  Kasai's rule, for all positions at once: where the neighbour of position
    p is the neighbour of p - 1 moved on by one, and p - 1 shares a byte, the prefix is one byte
    shorter; only the other positions compare bytes."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    fresh = np.ones(n, bool)
    fresh[1:] = before[1:] != before[:-1] + 1
    fresh[1:] |= before[:-1] < 0
    at = words_at(text)
    length = np.zeros(n, np.int64)
    a = np.flatnonzero(fresh & (before >= 0))
    while len(a):
        b = before[a]
        shared = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        while len(live):
            p, q = a[live] + shared[live], b[live] + shared[live]
            room = n - np.maximum(p, q)
            inside = room > 0
            live, p, q, room = live[inside], p[inside], q[inside], room[inside]
            differ = at[p] ^ at[q]
            low = differ & (~differ + np.uint64(1))  # the lowest bit in which they differ
            equal = np.where(differ == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) // 8)
            shared[live] += np.minimum(equal, room)
            live = live[(differ == 0) & (room > 8)]
        length[a] = shared
        lead = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        chained = length[lead] - (np.arange(n) - lead)
        # after a prefix of 0 the rule says nothing; at most one place a byte value has such a prefix
        a = np.flatnonzero((chained == -1) & (before >= 0))
        fresh[a] = True
    length = chained if n > 1 else length
    length[before < 0] = 0
    return length[order]


def compare(words: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """-1, 0 or 1 for the ``size`` bytes at a against those at b; the text as big-endian ``words_at``."""
    out = np.zeros(len(a), np.int8)
    live = np.arange(len(a))
    for k in range(0, size, 8):
        x, y = words[a[live] + k].astype(np.uint64), words[b[live] + k].astype(np.uint64)
        if size - k < 8:
            cut = np.uint64(8 * (8 - (size - k)))
            x, y = x >> cut, y >> cut
        out[live] = (x > y).astype(np.int8) - (x < y).astype(np.int8)
        live = live[x == y]
    return out


def locate(words: np.ndarray, known: np.ndarray, new: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of strings among known ones (positions of distinct strings, in order): the
    place of the first known string that isn't less, and whether it is equal."""
    low, high = np.zeros(len(new), np.int64), np.full(len(new), len(known), np.int64)
    live = np.flatnonzero(low < high)
    while len(live):
        mid = (low[live] + high[live]) // 2
        less = compare(words, known[mid], new[live], size) < 0
        low[live[less]] = mid[less] + 1
        high[live[~less]] = mid[~less]
        live = live[low[live] < high[live]]
    equal = np.zeros(len(new), bool)
    inside = np.flatnonzero(low < len(known))
    equal[inside] = compare(words, known[low[inside]], new[inside], size) == 0
    return low, equal


def equal_strings(texts: list[bytes], size: int, array_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for the ``size`` bytes from each window start of the texts (end to end) on, the
    same for equal strings; and the texts' first window, with the end."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate([[0], np.cumsum(sizes - size + 1)])
    ends = np.cumsum(sizes)
    text = np.frombuffer(b"".join(texts), np.uint8)
    words = words_at(text, big_endian=True)
    name = np.empty(first[-1], np.int64)
    known, names = np.zeros(0, np.int64), np.zeros(0, np.int64)  # distinct strings so far, in order, and their numbers
    lo = 0
    while lo < len(texts):
        begin = ends[lo] - sizes[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, begin + array_bytes, side="right")))
        part = text[begin:ends[hi - 1]]
        order, _ = suffix_array(part, size)
        shared = common_prefixes(part, order)
        windows = np.full(len(part), -1, np.int64)  # the window that begins at a position
        windows[ranges(ends[lo:hi] - sizes[lo:hi] - begin, sizes[lo:hi] - size + 1)] = np.arange(first[lo], first[hi])
        group = np.cumsum(shared < size) - 1
        real = windows[order] >= 0  # positions where no window begins only take part in the order
        _, lead, member = np.unique(group[real], return_index=True, return_inverse=True)
        at = order[real] + begin
        # merge: strings that an earlier array holds take its number, the others go in between
        place, equal = locate(words, known, at[lead], size)
        own = np.empty(len(lead), np.int64)
        own[equal] = names[place[equal]]
        own[~equal] = len(known) + np.arange((~equal).sum())
        name[windows[at - begin]] = own[member]
        known, names = np.insert(known, place[~equal], at[lead][~equal]), np.insert(names, place[~equal], own[~equal])
        lo = hi
    return name, first


# ---------------------------------------------------------------- the operator
def _windows(size: int, gram: int):
    def of(chunk: Chunk) -> Windows:
        h = words_at(chunk.buffer)[:len(chunk.buffer)].copy()
        width = 8
        while width < gram:  # gram is 8 times a power of two
            h = mix(h)
            far = np.zeros(len(h), np.uint64)
            far[:max(0, len(h) - width)] = h[width:]
            h += far * np.uint64(0x9E3779B97F4A7C15)
            width *= 2
        return Windows(mix(h), chunk.bounds, size, gram)

    return of


def _send(size: int, gram: int, buckets: int, shards: int):
    def run(chunk: Chunk, got: list[tuple[int, bytes]]) -> pa.Table:
        w = _windows(size, gram)(chunk)
        keys, _ = w.minimisers()
        flags = packed.flagged(keys, got, buckets)[np.searchsorted(keys, w.key)] if len(keys) else np.zeros(0, np.uint8)
        start, count, key = w.start[flags == 1], w.count[flags == 1], w.key[flags == 1]
        if (flags == 2).any():
            one = ranges(w.start[flags == 2], w.count[flags == 2])
            h = mix(packed.roll(words_at(chunk.buffer)[:len(chunk.buffer)], size - 7))
            start, count = np.concatenate([start, one]), np.concatenate([count, np.ones(len(one), np.int64)])
            key = np.concatenate([key, h[one]])
        order = np.argsort(key, kind="stable")
        start, count, key = start[order], count[order], key[order]
        text = np.searchsorted(chunk.bounds, start, side="right") - 1
        ids = np.where(chunk.nulls, np.iinfo(np.int64).min, chunk.ids)
        out = []
        for shard, a, b in packed.by_bucket(key, shards):
            n = count[a:b] + size - 1
            out.append({"bucket": shard, "chunk": chunk.name, "blob": Pieces.blob(
                chunk.buffer[ranges(start[a:b], n)], n, text[a:b].astype(np.int32),
                start[a:b] - chunk.bounds[text[a:b]], ids[text[a:b]])})
        return pa.Table.from_pylist(out, packed.BLOB_SCHEMA)

    return run


def _later(size: int, array_bytes: int):
    def run(_: int, blobs: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        pieces = Pieces(blobs)
        text, begin, ids = pieces.columns
        name, first = equal_strings(pieces.texts, size, array_bytes)
        counts = np.diff(first)
        # the earliest occurrence of each distinct string of windows
        order = np.lexsort((begin, text, pieces.chunk, ids, pieces.piece))
        lead = order[np.flatnonzero(np.diff(pieces.piece[order], prepend=-1))]
        # the earliest window of each name: by (document, start)
        piece = np.repeat(np.arange(len(counts)), counts)
        at = begin[lead][piece] + np.arange(len(piece)) - first[piece]
        of = lead[piece]
        by = np.lexsort((at, text[of], pieces.chunk[of], ids[of], name))
        earliest = np.zeros(len(name), bool)
        earliest[by[np.flatnonzero(np.diff(name[by], prepend=-1))]] = True
        hit = np.flatnonzero(~earliest)
        units = np.concatenate([[0], np.cumsum(counts + size - 1)])
        shift = units[piece[hit]] - first[piece[hit]]
        p, lo, hi = runs(covered(units[-1], hit + shift, hit + shift + size), units)
        # all other occurrences of a piece are later copies as a whole
        others = np.ones(len(pieces.piece), bool)
        others[lead] = False
        rest = np.flatnonzero(others)
        occurrence = np.concatenate([lead[p], rest])
        start = np.concatenate([lo - units[p], np.zeros(len(rest), np.int64)])
        end = np.concatenate([hi - units[p], (counts + size - 1)[pieces.piece[rest]]])
        yield from packed.answer_intervals(pieces, text, begin, occurrence, start, end)

    return run


def _finish(chunk: Chunk, got: list[tuple[int, bytes]]) -> pa.Table:
    text, lo, hi = packed.intervals(got)
    gone = covered(len(chunk.buffer), chunk.bounds[text] + lo, chunk.bounds[text] + hi)
    n = np.diff(chunk.bounds)
    removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[chunk.bounds])
    return pa.table([chunk.doc_ids(), pa.array(n), pa.array(removed),
                     packed.strings(n - removed, chunk.buffer[~gone], pa.binary()),
                     packed.span_lists(chunk.bounds, gone)], ["doc_id", "n_bytes", "n_removed", "kept", "spans"])


def remove_later_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM,
                        array_bytes: int = ARRAY_BYTES, hot_chunks: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, kept (the bytes left) and spans (the maximal removed runs)."""
    chunks = packed.pack(docs, doc_id=doc_id, text=text)
    total = packed.total_bytes(chunks)
    buckets = 1 + 2 * total // ((size - gram + 2) * packed.BUCKET_ENTRIES)
    shards = 1 + total // SHARD_BYTES
    flags = packed.repeated(chunks, _windows(size, gram), buckets, hot_chunks)
    sent = packed.with_answers(chunks, flags, _send(size, gram, buckets, shards), packed.BLOB)
    found = packed.in_buckets(sent, _later(size, array_bytes))
    return packed.with_answers(chunks, found, _finish, OUT)
