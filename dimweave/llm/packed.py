"""A corpus in chunks of a few MB, and numbers sent from chunks to buckets and back.

``pack`` turns documents into rows of one chunk each (ids, text bounds, compressed texts) and
checkpoints them in the cluster's shared folder: a chunk has a name that stays, so what a later
stage finds out can be sent back to it by that name.

``repeated`` is the common first step of the operators that look for equal windows: every chunk
sends the hashes that occur in it, each once, sorted and delta-coded, to buckets by hash range;
the buckets answer, in the order asked, how many chunks hold each.  A hash that a third of all
documents share is thereby one number for each chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.words import buffer_of, mix, slices
from dimweave.session import ensure_checkpoint_dir

CHUNK_BYTES = 4 << 20
#: Numbers that a bucket holds, on average.
BUCKET_ENTRIES = 200_000
CHUNK = "chunk long, part int, docs int, bytes long, ids binary, nulls binary, ends binary, texts binary"
BLOB = "bucket long, chunk long, blob binary"


def squeeze(*arrays: np.ndarray) -> bytes:
    """Numbers as bytes: each array's bytes by significance, so that equal high bytes compress."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T if a.size else np.zeros(0, np.uint8)
        raw = np.ascontiguousarray(planes).tobytes()
        parts += [np.array([a.size, ord(a.dtype.str[1]), a.dtype.itemsize], np.int64).tobytes(), raw]
    return zstandard.compress(b"".join(parts), 1)


def unsqueeze(blob: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    out, at = [], 0
    while at < len(raw):
        n, kind, width = raw[at:at + 24].view(np.int64).tolist()
        at += 24
        planes = raw[at:at + n * width].reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"{chr(kind)}{width}"))
        at += n * width
    return out


def squeeze_sorted(a: np.ndarray, *more: np.ndarray) -> bytes:
    return squeeze(np.diff(a, prepend=a.dtype.type(0)), *more)


def unsqueeze_sorted(blob: bytes) -> list[np.ndarray]:
    first, *more = unsqueeze(blob)
    return [np.cumsum(first, dtype=first.dtype), *more]


CHUNK_SCHEMA = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("docs", pa.int32()), ("bytes", pa.int64()),
                          ("ids", pa.binary()), ("nulls", pa.binary()), ("ends", pa.binary()), ("texts", pa.binary())])


class Chunk:
    """One chunk's documents: ``ids`` (int64), ``nulls`` (id is null), and the texts' bytes end
    to end in ``buffer`` between ``bounds``."""

    def __init__(self, row: dict):
        self.name, self.part = row["chunk"], row["part"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], bool)
        self.bounds = np.concatenate([[0], np.frombuffer(row["ends"], np.int64)])
        self.buffer = np.frombuffer(zstandard.decompress(row["texts"]), np.uint8) if row["bytes"] else np.zeros(0, np.uint8)

    def doc_ids(self) -> pa.Array:
        return pa.array(self.ids, mask=self.nulls)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name = TaskContext.get().partitionId() << 32
    for batch in batches:
        parts = batch["part"].unique().to_pylist()
        for part in parts:
            own = batch if len(parts) == 1 else batch.filter(pc.equal(batch["part"], part))
            for rows in slices(own, size=CHUNK_BYTES):
                buffer, bounds = buffer_of(rows["text"])
                ids = rows["doc_id"]
                yield pa.RecordBatch.from_pylist([{
                    "chunk": name, "part": part, "docs": rows.num_rows, "bytes": len(buffer),
                    "ids": ids.fill_null(0).to_numpy().tobytes(), "nulls": np.array(ids.is_null()).tobytes(),
                    "ends": bounds[1:].tobytes(), "texts": zstandard.compress(buffer.tobytes(), 3)}], CHUNK_SCHEMA)
                name += 1


def pack(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", part: Column | None = None) -> DataFrame:
    """The chunks; null texts count as empty.  Documents of different ``part`` (a whole number,
    not null) come into different chunks."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       (F.lit(0) if part is None else part).cast("int").alias("part"))
    return rows.mapInArrow(_pack, CHUNK).checkpoint()


def total_bytes(chunks: DataFrame) -> int:
    return chunks.agg(F.sum("bytes").alias("n")).collect()[0]["n"] or 0


def each_chunk(run: Callable[[Chunk], Iterator[dict]], schema: pa.Schema):
    """A mapInArrow function that runs over one chunk after the other."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(run(Chunk(batch.slice(i, 1).to_pylist()[0])))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
    return over


BLOB_SCHEMA = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("blob", pa.binary())])


def by_bucket(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of sorted hashes dealt into equal ranges."""
    b = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.diff(b, prepend=-1))
    return list(zip(b[starts].tolist(), starts.tolist(), np.append(starts[1:], len(b)).tolist()))


def with_answers(chunks: DataFrame, answers: DataFrame, run: Callable[[Chunk, list[tuple[int, bytes]]], pa.Table],
                 schema: str) -> DataFrame:
    """Each chunk with the blobs (bucket, chunk, blob) that were sent back to it, by bucket."""
    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        got = sorted(zip(right["bucket"].to_pylist(), right["blob"].to_pylist()))
        return run(Chunk(left.to_pylist()[0]), got)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(both, schema)


def in_buckets(sent: DataFrame, run: Callable[[int, list[tuple[int, bytes]]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Each bucket's blobs of all chunks -> (chunk, blob) to send back."""
    def group(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        back = list(run(bucket, sorted(zip(table["chunk"].to_pylist(), table["blob"].to_pylist()))))
        return pa.table([pa.array([bucket] * len(back), pa.int64()), pa.array([c for c, _ in back], pa.int64()),
                         pa.array([b for _, b in back], pa.binary())], schema=BLOB_SCHEMA)

    return sent.groupBy("bucket").applyInArrow(group, BLOB)


# ---------------------------------------------------------------- windows and their minimisers
def roll(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of ``size`` consecutive numbers, from every position on (shorter at the end), by
    doubling: equal runs of numbers get equal hashes."""
    def join(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
        out = a * np.uint64(0x9E3779B97F4A7C15)
        n = max(0, len(a) - shift)
        out[:n] += b[shift:]
        out ^= out >> np.uint64(32)
        return out * np.uint64(0xD6E8FEB86659FD93)

    done, out, power, width = 0, None, h, 1
    while True:
        if size & width:
            out = power if out is None else join(out, power, done)
            done += width
        if done == size:
            return out
        power = join(power, power, width)
        width *= 2


def sliding(best: np.ufunc, h: np.ndarray, size: int) -> np.ndarray:
    """The least (or greatest) of h[i : i + size], from every position on, shorter at the end."""
    out, width = h.copy(), 1
    while width < size:
        step = min(width, size - width)
        best(out[:-step] if step < len(out) else out[:0], out[step:], out=out[:-step] if step < len(out) else out[:0])
        width += step
    return out


class Windows:
    """The windows of ``size`` units of a row of units cut into texts (``first``: each text's
    first unit, with the end), and the minimiser of each: the least hash of its grams of ``gram``
    units.  Equal windows have equal minimisers."""

    def __init__(self, grams: np.ndarray, first: np.ndarray, size: int, gram: int):
        n = len(grams)
        self.width = size - gram + 1
        count = np.maximum(np.diff(first) - size + 1, 0)
        self.valid = np.zeros(n, bool)
        edges = np.zeros(n + 1, np.int32)
        np.add.at(edges, first[:-1][count > 0], 1)
        np.add.at(edges, (first[:-1] + count)[count > 0], -1)
        self.valid = np.cumsum(edges[:-1]) > 0
        self.least = sliding(np.minimum, grams, self.width)
        # runs of windows that share a minimiser: what travels together
        v = np.flatnonzero(self.valid)
        cut = np.ones(len(v), bool)
        cut[1:] = (v[1:] != v[:-1] + 1) | (self.least[v[1:]] != self.least[v[:-1]])
        begin = np.flatnonzero(cut)
        self.start = v[begin]  # first window of each run
        self.count = np.diff(np.append(begin, len(v)))  # windows of each run
        # least hashes lie near 0: mixed again, they spread over all buckets
        self.key = mix(self.least[self.start])
        self.grams = grams

    def minimisers(self) -> tuple[np.ndarray, np.ndarray]:
        """(each minimiser once, sorted; whether it occurs more than once as one)."""
        n = len(self.grams)
        if not len(self.start):
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        shown = np.where(self.valid, self.least, np.uint64(0))
        shown = sliding(np.maximum, shown[::-1], self.width)[::-1]  # the greatest least of the windows over a gram
        hit = np.flatnonzero((shown == self.grams) & (sliding(np.maximum, self.valid[::-1].view(np.uint8), self.width)[::-1] > 0))
        keys, counts = np.unique(mix(self.grams[hit]), return_counts=True)
        return keys, counts > 1


def repeated(chunks: DataFrame, windows: Callable[[Chunk], Windows], buckets: int,
             hot_chunks: int | None = None) -> DataFrame:
    """(bucket, chunk, blob): for each minimiser of a chunk, in order, 0 where it occurs nowhere
    else, else 1, or 2 where more than ``hot_chunks`` chunks hold it."""
    hot = HOT_CHUNKS if hot_chunks is None else hot_chunks

    def ask(chunk: Chunk) -> Iterator[dict]:
        keys, twice = windows(chunk).minimisers()
        for bucket, a, b in by_bucket(keys, buckets):
            yield {"bucket": bucket, "chunk": chunk.name, "blob": squeeze_sorted(keys[a:b], twice[a:b].view(np.uint8))}

    def answer(bucket: int, blobs: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        asked = [unsqueeze_sorted(b) for _, b in blobs]
        keys = np.concatenate([k for k, _ in asked])
        twice = np.concatenate([t for _, t in asked])
        _, place, n = np.unique(keys, return_inverse=True, return_counts=True)
        flags = np.where(n[place] > hot, 2, (n[place] > 1) | (twice > 0)).astype(np.uint8)
        at = 0
        for (chunk, _), (k, _) in zip(blobs, asked):
            own = flags[at:at + len(k)]
            at += len(k)
            if own.any():
                yield chunk, squeeze(own)

    sent = chunks.mapInArrow(each_chunk(ask, BLOB_SCHEMA), BLOB)
    return in_buckets(sent, answer)


#: A minimiser that more chunks hold is hot: its windows travel one by one, by their own hash.
HOT_CHUNKS = 4_096


def flagged(keys: np.ndarray, got: list[tuple[int, bytes]], buckets: int) -> np.ndarray:
    """The answers of ``repeated`` for a chunk's sorted minimisers, 0 where none came."""
    out = np.zeros(len(keys), np.uint8)
    blobs = dict(got)
    for bucket, a, b in by_bucket(keys, buckets):
        if bucket in blobs:
            out[a:b] = unsqueeze(blobs[bucket])[0]
    return out


# ---------------------------------------------------------------- pieces of text and what is removed
class Pieces:
    """Runs of windows that travel to a shard, as strings: each distinct string once, with its
    occurrences (chunk, text, first unit) and whatever else orders them."""

    def __init__(self, blobs: list[tuple[int, bytes]]):
        known: dict[bytes, int] = {}
        piece, chunk, rest = [], [], []
        for name, blob in blobs:
            raw, sizes, which, *own = unsqueeze(blob)
            data, ends = raw.tobytes(), np.cumsum(sizes).tolist()
            here = np.array([known.setdefault(data[a:b], len(known)) for a, b in zip([0, *ends], ends)], np.int64)
            piece.append(here[which])
            chunk.append(np.full(len(which), name))
            rest.append(own)
        self.texts = list(known)
        self.piece, self.chunk = np.concatenate(piece), np.concatenate(chunk)
        self.columns = [np.concatenate(c) for c in zip(*rest)]
        self.times = np.bincount(self.piece, minlength=len(known))

    @staticmethod
    def blob(raw: np.ndarray, sizes: np.ndarray, *columns: np.ndarray) -> bytes:
        """Strings (end to end in ``raw``), equal ones once, with a row of ``columns`` for each."""
        data, ends = raw.tobytes(), np.cumsum(sizes).tolist()
        known: dict[bytes, int] = {}
        which = np.array([known.setdefault(data[a:b], len(known)) for a, b in zip([0, *ends], ends)], np.int32)
        return squeeze(np.frombuffer(b"".join(known), np.uint8), np.fromiter(map(len, known), np.int32, len(known)), which, *columns)


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n units lie in one of the intervals."""
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, start, 1)
    np.add.at(edges, end, -1)
    return np.cumsum(edges[:-1]) > 0


def runs(mask: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the maximal runs of true units; none crosses from text to text."""
    n = len(mask)
    edge = np.zeros(n + 1, bool)
    edge[first] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    start = np.flatnonzero(mask & (~before | edge[:-1]))
    end = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return np.searchsorted(first, start, side="right") - 1, start, end


def answer_intervals(pieces: Pieces, text: np.ndarray, begin: np.ndarray, occurrence: np.ndarray, start: np.ndarray,
                     end: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Intervals of occurrences (relative to the piece) -> (chunk, blob of text, start, end)."""
    chunk, where = pieces.chunk[occurrence], text[occurrence]
    lo, hi = begin[occurrence] + start, begin[occurrence] + end
    order = np.lexsort((lo, where, chunk))
    chunk = chunk[order]
    cuts = np.flatnonzero(np.diff(chunk, prepend=-1))
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(chunk)).tolist()):
        rows = order[a:b]
        yield int(chunk[a]), squeeze(where[rows].astype(np.int32), lo[rows], hi[rows])


def intervals(got: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [unsqueeze(b) for _, b in got]
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*parts))


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def span_lists(first: np.ndarray, mask: np.ndarray) -> pa.Array:
    """For each text the runs of true units, counted from its first unit."""
    text, start, end = runs(mask, first)
    begin = first[text]
    offsets = np.searchsorted(text, np.arange(len(first))).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(start - begin), pa.array(end - begin)], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def strings(sizes: np.ndarray, raw: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    wide = pa.large_binary() if offsets[-1] >= 2**31 else pa.binary()
    offsets = offsets.astype(np.int64 if wide == pa.large_binary() else np.int32)
    own = pa.Array.from_buffers(wide, len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])
    return own.cast(kind)
