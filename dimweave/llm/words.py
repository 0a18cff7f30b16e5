"""Words of many texts at once, in numpy: where they lie and a 64-bit hash of each.

A word is a maximal run of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``).  The
texts of an Arrow batch lie end to end in one buffer, so one pass over the buffer finds the
words of all of them; words never cross texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that belong to no term; a term is a run of ASCII letters and bytes of other characters.
NO_TERM = np.ones(256, bool)
NO_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SLICE_BYTES = 4 << 20
#: Fixed values of the hashes: two odd multipliers.
FACTOR, OTHER_FACTOR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Words of more bytes are hashed one by one.
LONG_WORD = 4_096


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def words_at(buffer: np.ndarray, big_endian: bool = False) -> np.ndarray:
    """The 8 bytes from every position on as one number, zeros after the end."""
    padded = np.zeros(len(buffer) + 8, np.uint8)
    padded[:len(buffer)] = buffer
    return np.ndarray(len(buffer) + 1, ">u8" if big_endian else "<u8", padded, 0, (1,))


def hash_runs(buffer: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of bytes, 8 bytes at a time."""
    at = words_at(buffer)
    h = (size.astype(np.uint64) + np.uint64(seed)) * FACTOR
    live, pos, left = np.arange(len(start)), start, size
    if len(size) and size.max() > LONG_WORD:
        long = np.flatnonzero(size > LONG_WORD)
        h[long] = [int.from_bytes(hashlib.blake2b(buffer[a:a + n].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
                   for a, n in zip(start[long].tolist(), size[long].tolist())]
        live = np.flatnonzero(size <= LONG_WORD)
        pos, left = start[live], size[live]
    while len(live):
        part = at[pos]
        short = left < 8
        part[short] &= (np.uint64(1) << (left[short].astype(np.uint64) << np.uint64(3))) - np.uint64(1)
        x = (h[live] ^ part) * OTHER_FACTOR
        x ^= x >> np.uint64(29)
        h[live] = x * FACTOR
        more = left > 8
        live, pos, left = live[more], pos[more] + 8, left[more] - 8
    return mix(h)


@dataclass
class Words:
    """``start`` and ``end``: byte positions in ``buffer`` (uint8); ``text``: the number of the
    text that each word lies in; ``first``: the number of the first word of each text, and the
    number of words as a last entry; ``bounds``: the texts' byte positions, with the last end."""

    buffer: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A hash of each word's bytes."""
        return hash_runs(self.buffer, self.start, self.end - self.start, seed)

    def bytes_of(self, k: int) -> bytes:
        return self.buffer[self.start[k]:self.end[k]].tobytes()


def words_of(buffer: np.ndarray, bounds: np.ndarray, gap: np.ndarray = SPACE) -> Words:
    """The maximal runs, within each text, of bytes that ``gap`` doesn't mark."""
    n = len(buffer)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(buffer, bounds, none, none, none, np.zeros(len(bounds), np.int64))
    space = gap[buffer]
    edge = np.zeros(n + 1, bool)  # a text begins or ends here
    edge[bounds] = True
    before = np.ones(n, bool)
    before[1:] = space[:-1]
    start = np.flatnonzero(~space & (before | edge[:-1]))
    after = np.ones(n, bool)
    after[:-1] = space[1:]
    end = np.flatnonzero(~space & (after | edge[1:])) + 1
    text = np.searchsorted(bounds, start, side="right") - 1
    return Words(buffer, bounds, start, end, text, np.searchsorted(start, bounds))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string or binary column, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``size`` bytes of text; a longer text is a part of its own."""
    _, bounds = buffer_of(batch[column])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + size, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .. for length[0] numbers, then the same for the next."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start - (ends - length), length) + np.arange(total)
