"""Sequence packing by shortest-pack-first over the length histogram.

1. Every document is tokenised once, where its text lies; ids never leave the task.  It ends
   with one end token, is cut into pieces of ``max_len`` and one last, shorter piece.
2. The histogram of the last pieces' lengths (``max_len`` numbers at most) comes to the driver.
   Lengths are placed from the longest to the shortest, each into the packs with the most room
   that still take it; packs of equal make-up are one pattern with a count.
3. The patterns go back to the pieces by rank: the r-th piece of a length takes the r-th slot
   for that length.  Ranks are counted within (length, salt), so a length held by a third of
   all documents is ranked by many tasks.

Cases: null and empty texts are the end token alone; repeated rows and repeated ids are packed
like any others; an empty table gives an empty result; a document of any length is whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.words import buffer_of, ranges, slices, words_of
from dimweave.session import ensure_checkpoint_dir

MAX_LEN, END_ID, VOCABULARY = 2048, 1, "word_bpe_49k.json"
#: Words, and pieces of words, that a Python worker keeps with their ids, and ids that it keeps.
CACHE_WORDS, CACHE_IDS = 300_000, 3_000_000
SALTS = 64
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


#: The vocabulary's pre-tokenizer for lower-cased words of ASCII and Latin-1
#: letters, with the line end between two words; and any other characters.
PIECES_OF_WORDS = re.compile(
    "\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\na-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
OTHER = re.compile("[^\n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
BREAK = np.uint32(0xFFFFFFFF)  # no token has this id


class WordIds:
    """Texts' ids, word by word.

    The tokenizer's normaliser and pre-tokenizer treat the words between ASCII white space
    apart from each other, so a text's ids are its words' ids in a row, and each distinct word
    of a slice is looked up once.  Unknown words of ASCII and Latin-1 letters are cut into the
    pre-tokenizer's pieces here; unknown pieces go to the tokenizer many at a time, and come
    apart again at the tokens that end a piece.  Any other word goes to the tokenizer alone.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_piece = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_piece[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words: dict[int, int] = {}  # a word's hash to its place in the next three
        self.flat, self.at, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pieces: dict[str, bytes] = {"\n": BREAK.tobytes()}

    def _learn(self, found: list[str]) -> None:
        new = list({*found}.difference(self.pieces))
        ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(
            [" ".join(new[i:i + 500]) for i in range(0, len(new), 500)], add_special_tokens=False)]
        flat = np.concatenate([*ids, np.zeros(0, np.uint32)])
        ends = (4 * (np.flatnonzero(self.ends_piece[flat]) + 1)).tolist()
        if len(ends) != len(new):
            raise ValueError("the vocabulary's pieces don't end in </w>")
        raw = flat.tobytes()
        self.pieces.update(zip(new, (raw[a:b] for a, b in zip([0, *ends], ends))))

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids in a row, and how many each has."""
        joined = "\n".join(words)
        ends = [joined.find("\n", m.end()) for m in OTHER.finditer(joined)]
        other = {joined[joined.rfind("\n", 0, e if e >= 0 else None) + 1:e if e >= 0 else None] for e in ends}
        if "<|" in joined:  # may hold a special token
            other.update(w for w in words if "<|" in w)
        plain = [w for w in words if w not in other] if other else words
        if len(self.pieces) > CACHE_WORDS:
            self.pieces = {"\n": BREAK.tobytes()}
        found = PIECES_OF_WORDS.findall("\n".join(plain).lower())
        self._learn(found)
        flat = np.frombuffer(b"".join(map(self.pieces.__getitem__, found)), np.uint32)
        cut = np.flatnonzero(flat == BREAK)
        sizes = np.diff(np.concatenate([[-1], cut, [len(flat)]])) - 1
        flat = flat[flat != BREAK]
        if not other:
            return flat, sizes
        own = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32) for w in words if w in other]
        theirs = np.fromiter((w in other for w in words), bool, len(words))
        counts = np.zeros(len(words), np.int64)
        counts[theirs], counts[~theirs] = [len(o) for o in own], sizes[:len(plain)]
        out = np.zeros(counts.sum(), np.uint32)
        at = np.cumsum(counts) - counts
        out[ranges(at[~theirs], counts[~theirs])] = flat
        out[ranges(at[theirs], counts[theirs])] = np.concatenate(own)
        return out, counts

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column's texts, and where each text's ids begin, with the end."""
        words = words_of(*buffer_of(column))
        if not len(words.start):
            return np.zeros(0, np.uint32), np.zeros(len(words.bounds), np.int64)
        codes, keys = pd.factorize(words.hashes())  # distinct words, in the order in which they first occur
        first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))
        keys = keys.tolist()
        place = np.fromiter(map(self.words.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(place < 0)
        if len(new):
            flat, sizes = self._encode([words.bytes_of(k).decode() for k in first[new]])
            at = len(self.flat) + np.cumsum(sizes) - sizes
            place[new] = len(self.at) + np.arange(len(new))
            flat, at, sizes = np.concatenate([self.flat, flat]), np.concatenate([self.at, at]), np.concatenate([self.size, sizes])
            room = max(0, min(CACHE_WORDS, CACHE_IDS - len(flat)) - len(self.words))
            if room >= len(new):
                self.words.update(zip([keys[k] for k in new], place[new].tolist()))
                self.flat, self.at, self.size = flat, at, sizes
        else:
            flat, at, sizes = self.flat, self.at, self.size
        at, counts = at[place[codes]], sizes[place[codes]]
        begin = np.concatenate([[0], np.cumsum(counts)])[words.first]
        return flat[ranges(at, counts)], begin


@lru_cache(1)  # a reused Python worker keeps what it knows
def word_ids(vocabulary: str) -> WordIds:
    import public_tokenizers

    return WordIds(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))


def _cut(max_len: int, end_id: int, vocabulary: str):
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(vocabulary)
        for part in (p for batch in batches for p in slices(batch)):
            flat, begin = known.ids(part["text"])
            out: list[tuple] = []
            for doc, lo, hi in zip(part["doc_id"].to_pylist(), begin[:-1].tolist(), begin[1:].tolist()):
                n = hi - lo + 1
                view = memoryview(np.concatenate([flat[lo:hi], end]).tobytes())
                out += [(doc, s, min(max_len, n - s), zlib.crc32(view[4 * s:4 * (s + max_len)]), n)
                        for s in range(0, n, max_len)]
            cols = list(zip(*out)) or [()] * 5
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols],
                                  ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def shortest_pack_first(histogram: Mapping[int, int], max_len: int) -> list[tuple[int, tuple[int, ...]]]:
    """[(count, lengths of a pack)]: lengths placed longest first, into the packs with the
    most room that take them."""
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in by_room.items() if packs and r >= length), default=None)
            if room is None:  # new packs, each with as many of this length as it takes
                copies = min(left, max_len // length)
                count, pack, room = left // copies, (length,) * copies, max_len - length * copies
                by_room.setdefault(room, []).append((count, pack))
                left -= count * copies
                continue
            count, pack = by_room[room].pop()
            if count > left:
                by_room[room].append((count - left, pack))
                count = left
            by_room.setdefault(room - length, []).append((count, (*pack, length)))
            left -= count
    return [x for room in sorted(by_room) for x in by_room[room]]


def _slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset)."""
    out, used, sequence = [], {}, 0
    for count, pack in patterns:
        offset = 0
        for length in pack:
            first = used.get(length, 0)
            out.append((length, first, first + count - 1, sequence, offset))
            used[length] = first + count
            offset += length
        sequence += count
    return out


def pack_sequences(docs: DataFrame, *, max_len: int = MAX_LEN, end_id: int = END_ID,
                   vocabulary: str = VOCABULARY, salts: int = SALTS) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset.  ``vocabulary`` is a file name of the public tokenizers or a path."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = pieces.mapInArrow(_cut(max_len, end_id, vocabulary), PIECES).checkpoint()
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(_slots(shortest_pack_first(histogram, max_len)),
                                  "length long, first long, last long, base long, offset long")
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
             .withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = (salted.withColumn("r", F.row_number().over(within) - 1).join(shift, ["length", "salt"])
              .withColumn("rank", F.col("r") + F.col("shift")))
    # at most a few slots for each of max_len lengths: bounded by the parameter, so broadcast
    placed = ranked.join(F.broadcast(slots), "length").filter(F.col("rank").between(F.col("first"), F.col("last")))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         (F.col("base") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")
