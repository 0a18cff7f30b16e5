"""Language-model scores by deleted interpolation of n-grams.

P(w | v) mixes the bigram and unigram maximum-likelihood estimates and a uniform share,

    a2[b] c(v w) / c(v) + a1[b] c(w) / N + a0[b] / (V + 1),

with weights for each bucket b of the context's frequency c(v).  The weights are learned by
expectation-maximisation on a held-out slice of the training documents, whose own counts are
taken out of c, N for that; scores then use the counts of all training documents.

Counting and scoring are one exchange.  Every chunk of documents sends its distinct n-grams
(hashes of ``BITS`` bits, sorted, delta-coded, with their counts in the chunk's training
documents) to buckets by hash range; a bucket adds them up and sends the totals back to the
chunks that asked, in the order asked.  A frequent n-gram is thereby one number for each chunk,
and the counts gathered grow with the corpus.

Tokens: words between ASCII white space with A-Z lower-cased, then one end.  A text begins in a
start context, which is no token.

Cases: null and empty texts are the end alone; documents with a null id are scored but not
learned from; repeated rows count (and are scored) each; without training documents c = N = V =
0; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm import packed
from dimweave.llm.packed import Chunk, squeeze, squeeze_sorted, unsqueeze, unsqueeze_sorted
from dimweave.llm.words import LOWER, mix, words_of

#: Of the hashes' 64 bits; equal n-grams always meet, different ones share a hash with a chance
#: of about (distinct n-grams) / 2**BITS.
BITS = 56
BUCKET_ENTRIES = 500_000
END, START = np.uint64(0x5DEECE66D1234567), np.uint64(0x2545F4914F6CDD1D)
PARTS, HELD_OUT, SLICE = 7, 2, 5
ROUNDS, GRID, LEAST = 60, 4, 1e-5
LOG10 = np.log(10)
OUT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


@dataclass
class Tokens:
    """A chunk's tokens: the place of each one's unigram, context and bigram among the chunk's
    sorted distinct ``keys``; ``doc`` of each token and ``begin`` of each document, with the end."""

    keys: np.ndarray
    unigram: np.ndarray
    context: np.ndarray
    bigram: np.ndarray
    doc: np.ndarray
    begin: np.ndarray


def tokens_of(chunk: Chunk) -> Tokens:
    words = words_of(LOWER[chunk.buffer], chunk.bounds)
    docs = len(chunk.ids)
    begin = words.first + np.arange(docs + 1)
    token = np.empty(begin[-1], np.uint64)
    token[np.arange(len(words.start)) + words.text] = words.hashes()
    token[begin[1:] - 1] = END
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[begin[:-1]] = START
    mask = ~np.uint64((1 << (64 - BITS)) - 1)
    pair = mix(context * np.uint64(0x9E3779B97F4A7C15) + (token ^ np.uint64(1))) & mask
    keys, place = np.unique(np.concatenate([token & mask, pair, [START & mask]]), return_inverse=True)
    n = len(token)
    unigram, bigram = place[:n], place[n:2 * n]
    before = np.empty(n, place.dtype)
    before[1:] = unigram[:-1]
    before[begin[:-1]] = place[-1]
    return Tokens(keys, unigram, before, bigram, np.repeat(np.arange(docs), np.diff(begin)), begin)


def parts_of(chunk: Chunk) -> np.ndarray:
    """crc32 of each id as text modulo PARTS; -1 for a null id."""
    crc = np.array([zlib.crc32(b"%d" % i) % PARTS for i in chunk.ids.tolist()], np.int64)
    return np.where(chunk.nulls, -1, crc)


def _ask(buckets: int):
    def run(chunk: Chunk) -> Iterator[dict]:
        t = tokens_of(chunk)
        if not len(t.doc):
            return
        part = parts_of(chunk)
        learned = (part >= 0) & (part != HELD_OUT)
        use = learned[t.doc]
        n = len(t.keys)
        count = np.bincount(t.unigram[use], minlength=n) + np.bincount(t.bigram[use], minlength=n)
        first = np.zeros(n, np.uint8)  # 1: a token by itself, 2: the start context
        first[t.unigram] = 1
        start = t.context[0]
        first[start] = 2
        count[start] += learned.sum()
        # the slice's documents fill chunks of their own, so a chunk's counts are its slice or none of it
        for bucket, a, b in packed.by_bucket(t.keys, buckets):
            yield {"bucket": bucket, "chunk": chunk.name, "blob": squeeze_sorted(
                t.keys[a:b], count[a:b].astype(np.uint32), first[a:b], np.array([chunk.part], np.uint8))}

    return run


def _answer(_: int, blobs: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    asked = [unsqueeze_sorted(b) for _, b in blobs]
    keys, place = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
    counts = np.concatenate([a[1] for a in asked]).astype(np.float64)
    sliced = np.concatenate([np.full(len(a[0]), a[3][0]) for a in asked])
    total = np.bincount(place, counts, len(keys)).astype(np.int64)
    inner = np.bincount(place, counts * sliced, len(keys)).astype(np.int64)
    kind = np.zeros(len(keys), np.uint8)
    kind[place] = np.concatenate([a[2] for a in asked])
    words = kind == 1
    yield -1, squeeze(np.array([total[words].sum(), inner[words].sum(), (total[words] > 0).sum()], np.int64))
    at = 0
    for (chunk, _), a in zip(blobs, asked):
        own = place[at:at + len(a[0])]
        at += len(own)
        yield chunk, squeeze(total[own], inner[own]) if a[3][0] else squeeze(total[own])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [unsqueeze(b)[0] for b in batch["blob"].to_pylist()]
        if rows:
            total = np.sum(rows, axis=0)
            yield pa.record_batch([pa.array([x]) for x in total.tolist()], ["n", "n_slice", "v"])


def _counts(t: Tokens, got: list[tuple[int, bytes]], which: int) -> np.ndarray:
    parts = [unsqueeze(b)[which] for _, b in got]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the whole part of log2 of its frequency."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0).astype(np.int64)


def _estimates(t: Tokens, count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, bigram estimate, unigram estimate) of each token."""
    seen = count[t.context]
    return bucket_of(seen), count[t.bigram] / np.maximum(seen, 1), count[t.unigram] / max(n, 1)


def _histogram(n: int):
    """Tokens of the slice by bucket and by the size of their two estimates, without the slice's
    own counts."""
    def cell(p: np.ndarray) -> np.ndarray:
        return np.where(p > 0, np.round(GRID * np.log2(np.maximum(p, 1e-300))), 1).astype(np.int32)

    def run(chunk: Chunk, got: list[tuple[int, bytes]]) -> pa.Table:
        t = tokens_of(chunk)
        if got and len(t.doc):
            count = _counts(t, got, 0) - _counts(t, got, 1)
            b, p2, p1 = _estimates(t, count, n)
        else:
            b, p2, p1 = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        cells, place = np.unique(np.stack([b, cell(p2), cell(p1)]), axis=1, return_inverse=True)
        sums = [np.bincount(place.reshape(-1), w, cells.shape[1]) for w in (np.ones(len(b)), p2, p1)]
        return pa.table([pa.array(c.astype(np.int32)) for c in cells] + [pa.array(s) for s in sums],
                        ["b", "q2", "q1", "n", "p2", "p1"])

    return run


def mixture(cells: list[tuple[int, float, float, float]], v: int) -> dict[int, tuple[float, float, float]]:
    """Weights (bigram, unigram, uniform) for each bucket by expectation-maximisation; cells:
    (bucket, tokens, their mean bigram and unigram estimates)."""
    out = {}
    for bucket in {c[0] for c in cells}:
        own = np.array([c[1:] for c in cells if c[0] == bucket])
        p = np.stack([own[:, 1], own[:, 2], np.full(len(own), 1 / (v + 1))])
        a = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            joint = a[:, None] * p
            a = (joint / joint.sum(0) * own[:, 0]).sum(1)
            a = np.maximum(a / a.sum(), LEAST)
            a /= a.sum()
        out[bucket] = tuple(a.tolist())
    return out


def _score(n: int, v: int, weights: dict[int, tuple[float, float, float]]):
    table = np.full((66, 3), 1 / 3)
    for bucket in range(66):
        if weights:  # a bucket that the slice doesn't show takes the nearest one's
            table[bucket] = weights[min(weights, key=lambda k: (abs(k - bucket), k))]
    table[0] = table[0] * [0, 1, 1] / table[0, 1:].sum()  # an unseen context has no bigram estimate

    def run(chunk: Chunk, got: list[tuple[int, bytes]]) -> pa.Table:
        t = tokens_of(chunk)
        docs = len(chunk.ids)
        count = _counts(t, got, 0) if len(t.doc) else np.zeros(0, np.int64)
        own = count[t.unigram]
        b, p2, p1 = _estimates(t, count, n)
        a = table[b]
        p = a[:, 0] * p2 + a[:, 1] * p1 + a[:, 2] / (v + 1)
        add = lambda x: np.bincount(t.doc, x, docs)
        part = parts_of(chunk)
        return pa.table([chunk.doc_ids(), pa.array(part == HELD_OUT), pa.array(np.diff(t.begin)),
                         pa.array(add(own > 0).astype(np.int64)), pa.array(np.full(docs, n)),
                         pa.array(add(np.log((own + 1) / (n + v + 1)) / LOG10)), pa.array(add(np.log(p) / LOG10))],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score_texts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens, base_score
    (add-one unigrams) and score (the model), both log10 probabilities of the whole text."""
    crc = F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % PARTS
    chunks = packed.pack(docs, doc_id=doc_id, text=text, part=F.coalesce((crc == SLICE).cast("int"), F.lit(0)))
    buckets = 1 + packed.total_bytes(chunks) // (6 * BUCKET_ENTRIES)
    sent = chunks.mapInArrow(packed.each_chunk(_ask(buckets), packed.BLOB_SCHEMA), packed.BLOB)
    found = packed.in_buckets(sent, _answer).checkpoint()  # read by the fit and by the scores
    sums = found.filter("chunk = -1").select("blob").mapInArrow(_sums, "n long, n_slice long, v long")
    sums = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "n_slice", "v")]).collect()[0]
    n, v = sums["n"], sums["v"]
    found = found.filter("chunk >= 0")
    slice_ = chunks.filter("part = 1")
    cells = packed.with_answers(slice_, found.join(slice_.select("chunk"), "chunk", "left_semi"), _histogram(n - sums["n_slice"]),
                                "b int, q2 int, q1 int, n double, p2 double, p1 double")
    cells = cells.groupBy("b", "q2", "q1").agg(*[F.sum(c).alias(c) for c in ("n", "p2", "p1")]).collect()  # a bounded grid
    weights = mixture([(r["b"], r["n"], r["p2"] / r["n"], r["p1"] / r["n"]) for r in cells], v)
    return packed.with_answers(chunks, found, _score(n, v, weights), OUT)
