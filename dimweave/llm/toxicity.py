"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

1. Examples: up to ``EXAMPLES`` labelled training documents of each class, and up to
   ``CALIBRATION`` others as they come, all by the hash of their id: a bounded sample of the
   labelled rows, one text for each id.
2. Vectors: tf-idf of every term of a text, of length 1.  Document frequencies are counted over
   all documents; a term in fewer than ``LEAST_SHARE`` of them counts as being in that share.  So
   the idf table that tasks hold has at most (mean number of terms of a document) / LEAST_SHARE
   entries, however large the corpus.
3. Every document is compared with the examples of each class: short inverted lists are added up
   whole, long ones (those in more than ``LONG_LIST`` of the class) by block of examples, and only in
   blocks whose upper bound, from the largest weight of each list in the block, reaches the k-th
   nearest.
4. Votes: a nearest example votes with the part of its cosine that comes from telling terms, those
   which the classes of examples use differently (chi-squared of at least ``TELLING``), each times
   its chi-squared.  The mean vote of the k nearest toxic examples less that of the k nearest
   others becomes a rate by an isotonic fit on the calibration rows.  By the whole cosine, the
   nearest examples tell the subject, and votes by it are right less often (see the README).
   The examples whose votes weigh most are the evidence.

Terms are runs of ASCII letters and non-ASCII characters, with A-Z lower-cased; every term of a
text counts, whatever its length.

Cases: a null or empty text, or one that shares no telling term with an example, has a vote of 0
and gets the rate of such calibration rows; without labels every score is 0; repeated rows get
equal scores; of several texts with a sampled id the one with the least hash counts;
a document labelled both ways counts as toxic; ties between examples go to the smaller id; an
empty table gives an empty result; input columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.llm.words import LOWER, NO_TERM, buffer_of, ranges, slices, words_of

EXAMPLES, CALIBRATION = 2_048, 6_144
LEAST_SHARE = 2.0 ** -14
LONG_LIST = 1 / 8
#: chi-squared that a term without a class exceeds once in a thousand times.
TELLING = 10.83
#: Distinct terms that a task counts before it hands them on.
HELD_TERMS = 1 << 20
NEIGHBOURS, BLOCK, SHOWN = 50, 64, 15
#: Documents that are compared with the examples at once.
AT_ONCE = 64
#: Bytes of text that a task turns into vectors at once.
PART_BYTES = 1 << 20
THRESHOLD = 0.3
EVIDENCE = T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("similarity", T.DoubleType()),
                                     T.StructField("toxic", T.IntegerType())]))
OUT = ["score", "predicted", "evidence"]


def crc_part(doc_id: Column, parts: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


@dataclass
class Sparse:
    """Rows of (number of a term, count), ``row`` and in it ``term`` ascending; ``hashes``: the
    terms, ascending."""

    hashes: np.ndarray
    row: np.ndarray
    term: np.ndarray
    count: np.ndarray


def term_counts(column: pa.Array) -> Sparse:
    """Occurrences of terms in each text."""
    buffer, bounds = buffer_of(column)
    terms = words_of(LOWER[buffer], bounds, NO_TERM)
    if not len(terms.start):
        return Sparse(np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    hashes, number = np.unique(terms.hashes(), return_inverse=True)
    keys, count = np.unique(terms.text * len(hashes) + number, return_counts=True)
    return Sparse(hashes, keys // len(hashes), keys % len(hashes), count)


def find(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``known``, ascending, and whether it is there) of each hash."""
    if not len(known):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return at, known[at] == hashes


class BlockMaxIndex:
    """Inverted lists of unit vectors in blocks of ``block`` examples.  Lists of more than
    ``long_list`` of the examples are long: they have their largest weight in each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK, long_list: float = LONG_LIST):
        self.n, self.block, self.blocks = len(vectors), block, max(1, -(-len(vectors) // block))
        none = [np.zeros(0)]
        size = np.array([len(t) for t, _ in vectors], np.int64)
        row = np.repeat(np.arange(self.n), size)
        term = np.concatenate([*(t for t, _ in vectors), *none]).astype(np.int64)
        weight = np.concatenate([*(w for _, w in vectors), *none])
        is_long = np.bincount(term, minlength=n_terms) > max(block, long_list * self.n)
        # examples whose heaviest long list, then heaviest list, is the same lie together, so that
        # a block holds one language or subject and few blocks have high bounds
        def heaviest(of: np.ndarray) -> np.ndarray:
            out = np.full(self.n, n_terms)
            by = np.lexsort((-weight[of], row[of]))
            rows, at = np.unique(row[of][by], return_index=True)
            out[rows] = term[of][by][at]
            return out

        self.order = np.lexsort((np.arange(self.n), heaviest(np.arange(len(term))), heaviest(np.flatnonzero(is_long[term]))))
        place = np.empty(self.n, np.int64)
        place[self.order] = np.arange(self.n)
        row = place[row]
        by = np.lexsort((row, term))
        row, term, weight = row[by], term[by], weight[by]
        self.first = np.searchsorted(term, np.arange(n_terms + 1))
        self.row, self.weight = row.astype(np.int32), weight
        # of the long lists: the largest weight in each block
        self.width = self.blocks * block
        self.long = np.full(n_terms, -1, np.int32)
        lists = np.flatnonzero(is_long)
        self.long[lists] = np.arange(len(lists))
        own = np.flatnonzero(is_long[term])
        self.top = np.zeros((len(lists), self.blocks))
        np.maximum.at(self.top, (self.long[term[own]], row[own] // block), weight[own])
        self._whole: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_whole": None}

    def whole(self) -> np.ndarray:
        """The long lists written out, block by block; made where it is first used."""
        if self._whole is None:
            lists = np.flatnonzero(self.long >= 0)
            size = self.first[lists + 1] - self.first[lists]
            at = ranges(self.first[lists], size)
            out = np.zeros((self.blocks, len(lists), self.block))
            out[self.row[at] // self.block, np.repeat(np.arange(len(lists)), size), self.row[at] % self.block] = self.weight[at]
            self._whole = out
        return self._whole

    def _short(self, q: int, doc: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Sums of (document, example) along the lists of the terms."""
        size = self.first[term + 1] - self.first[term]
        at = ranges(self.first[term], size)
        sums = np.bincount(np.repeat(doc * self.width, size) + self.row[at], np.repeat(weight, size) * self.weight[at], q * self.width)
        return sums.astype(float).reshape(q, self.blocks, self.block)

    def _finish(self, score: np.ndarray, long: np.ndarray, todo: np.ndarray) -> None:
        """Adds the long lists for the (document, block) pairs of ``todo``."""
        for b, lists in enumerate(self.whole()):
            docs = np.flatnonzero(todo[:, b])
            if len(docs) == len(long):
                score[:, b] += long @ lists
            elif len(docs):
                score[docs, b] += long[docs] @ lists

    def search(self, q: int, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int,
               telling: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For q documents, whose terms and weights are given with the document's number: (document,
        example, cosine, cosine along the terms' ``telling``) of the k examples of highest cosine
        over 0, by document, best first."""
        none = np.zeros(0)
        if not self.n or not len(term):
            return none.astype(np.int64), none.astype(np.int64), none, none
        number = self.long[term]
        short = number < 0
        score = self._short(q, doc[short], term[short], weight[short])
        long = np.zeros((q, len(self.top)))
        long[doc[~short], number[~short]] = weight[~short]
        bound = score.max(axis=2) + long @ self.top + 1e-9
        # first the blocks of the highest bounds, which hold k examples: what they reach bounds the others
        head = min(self.blocks, -(-2 * k // self.block))
        done = np.zeros((q, self.blocks), bool)
        np.put_along_axis(done, np.argsort(-bound, axis=1, kind="stable")[:, :head], True, 1)
        self._finish(score, long, done)
        reach = np.zeros(q)
        if self.width > k:
            reach = np.partition(np.where(done[:, :, None], score, 0).reshape(q, -1), self.width - k, axis=1)[:, self.width - k]
        rest = ~done & (bound >= np.maximum(reach, 1e-300)[:, None])
        self._finish(score, long, rest)
        score[~(done | rest)] = 0.0  # lists left out: below the k-th nearest
        score = np.round(score, 9).reshape(q, -1)
        if self.width > k:
            reach = np.partition(score, self.width - k, axis=1)[:, self.width - k]
        who, place = np.nonzero((score > 0) & (score >= reach[:, None]))
        cosine = score[who, place]
        by = np.lexsort((self.order[place], -cosine, who))
        who, place, cosine = who[by], place[by], cosine[by]
        best = np.arange(len(who)) - np.searchsorted(who, who) < k
        who, place, cosine = who[best], place[best], cosine[best]
        told = np.zeros(len(who))
        if telling is not None:
            tells = telling[term] > 0
            parts = self._short(q, doc[tells & short], term[tells & short], (weight * telling[term])[tells & short])
            some = np.unique(number[tells & ~short])
            facts = np.zeros(len(self.top))
            facts[number[tells & ~short]] = telling[term[tells & ~short]]
            told = parts.reshape(q, -1)[who, place]
            if len(some):
                told += np.einsum("ij,ij->i", (long[:, some] * facts[some])[who], self.whole()[place // self.block, :, place % self.block][:, some])
        return who, self.order[place], cosine, told

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k examples of highest cosine over 0 to one document, as (cosine, example), best first."""
        _, who, cosine, _ = self.search(1, np.zeros(len(terms), np.int64), terms, weights, k)
        return list(zip(cosine.tolist(), who.tolist()))


@dataclass
class Model:
    """What tasks need: small, bounded by the parameters."""

    held: np.ndarray  # the terms in LEAST_SHARE of the documents or more, ascending
    held_idf: np.ndarray
    most: float  # the idf of any other term
    vocabulary: np.ndarray  # the examples' terms, ascending
    telling: np.ndarray  # their chi-squared where it tells, else 0
    index: list[BlockMaxIndex]  # of the examples that aren't toxic, and of those that are
    ids: list[np.ndarray]
    steps: np.ndarray  # the isotonic fit: votes from steps[i] on get rates[i]
    rates: np.ndarray

    def vectors(self, counts: Sparse, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Unit vectors over all terms, of which those that an example holds are given."""
        idf = np.full(len(counts.hashes), self.most)
        at, known = find(self.held, counts.hashes)
        idf[known] = self.held_idf[at[known]]
        at, known = find(self.vocabulary, counts.hashes)
        w = (1 + np.log(counts.count)) * idf[counts.term]
        if len(w):
            w = w / np.sqrt(np.bincount(counts.row, w * w, n))[counts.row]
        given = known[counts.term]
        row, term, w = counts.row[given], at[counts.term[given]], w[given]
        cut = np.searchsorted(row, np.arange(n + 1))
        return [(term[a:b], w[a:b]) for a, b in zip(cut[:-1], cut[1:])]

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]], shown: int = 0) -> list[tuple[float, list[dict]]]:
        """For each document its vote, and the ``shown`` examples that weigh most in it."""
        # without a telling term the vote is 0 whatever the nearest examples are
        asked = [i for i, (t, _) in enumerate(vectors) if len(t) and (shown or (self.telling[t] > 0).any())]
        out: list[tuple[float, list[dict]]] = [(0.0, [])] * len(vectors)
        for lo in range(0, len(asked), AT_ONCE):
            own = asked[lo:lo + AT_ONCE]
            q, size = len(own), [len(vectors[i][0]) for i in own]
            given = [np.repeat(np.arange(q), size), *(np.concatenate([vectors[i][c] for i in own]) for c in (0, 1))]
            vote, near = np.zeros(q), [[] for _ in own]
            for toxic, index in enumerate(self.index):
                doc, who, cosine, told = index.search(q, *given, NEIGHBOURS, self.telling)
                vote += (1 if toxic else -1) * np.bincount(doc, told, q) / NEIGHBOURS
                if shown:
                    for d, *x in zip(doc.tolist(), (-told).tolist(), (-cosine).tolist(), self.ids[toxic][who].tolist()):
                        near[d].append((*x, toxic))
            for i, v, found in zip(own, np.round(vote, 9).tolist(), near):
                out[i] = v, [{"doc_id": d, "similarity": -c, "toxic": y} for _, c, d, y in sorted(found)[:shown]]
        return out

    def rate(self, vote: float) -> float:
        return float(self.rates[max(0, np.searchsorted(self.steps, vote, side="right") - 1)]) if len(self.steps) else 0.0


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function nearest to y, by pooling neighbours that fall."""
    pools: list[list[float]] = []  # first x, sum, count
    for value in np.unique(x):
        own = y[x == value]
        pools.append([value, own.sum(), len(own)])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            _, s, c = pools.pop()
            pools[-1][1] += s
            pools[-1][2] += c
    return np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _pick(labels: DataFrame, holdout: tuple[int, int]) -> dict[int, tuple[str, int]]:
    """{doc_id: (use, toxic)} of the bounded sample."""
    parts, out = holdout
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("toxic").isin(0, 1) & (crc_part(F.col("doc_id"), parts) != out))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64(F.lit(6), "doc_id")
    known = known.withColumn("use", F.pmod(F.xxhash64(F.lit(61), "doc_id"), F.lit(2)))
    chosen: dict[int, tuple[str, int]] = {}
    for y in (0, 1):
        rows = known.filter((F.col("use") == 0) & (F.col("toxic") == y)).orderBy(order).limit(EXAMPLES).collect()
        chosen |= {r["doc_id"]: ("example", y) for r in rows}
    rows = known.filter("use = 1").orderBy(order).limit(CALIBRATION).collect()
    return chosen | {r["doc_id"]: ("calibration", r["toxic"]) for r in rows}


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of the task's texts each term occurs."""
    known, df = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    batch = lambda: pa.record_batch([pa.array(known.view(np.int64)), pa.array(df)], ["h", "n"])
    for part in (p for b in batches for p in slices(b)):
        c = term_counts(part["text"])
        both, number = np.unique(np.concatenate([known, c.hashes]), return_inverse=True)
        own = np.bincount(c.term, minlength=len(c.hashes))
        known, df = both, np.bincount(number, np.concatenate([df, own]), len(both)).astype(np.int64)
        if len(known) > HELD_TERMS:
            yield batch()
            known, df = known[:0], df[:0]
    yield batch()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in (p for b in batches for p in slices(b)):
        c = term_counts(part["text"])
        cut = np.searchsorted(c.row, np.arange(part.num_rows + 1)).astype(np.int32)
        arrays = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in (c.hashes.view(np.int64)[c.term], c.count.astype(np.int32))]
        yield pa.record_batch([part["doc_id"], part["text_hash"], *arrays], ["doc_id", "text_hash", "terms", "counts"])


def chi_squared(term: np.ndarray, toxic: np.ndarray, n_terms: int, n0: int, n1: int) -> np.ndarray:
    """chi-squared of each term and the class; ``term`` and ``toxic`` of each (example, term), and
    the number of examples of both classes."""
    a, b = (np.bincount(term[toxic == y], minlength=n_terms).astype(float) for y in (1, 0))
    c, d = n1 - a, n0 - b
    den = (a + b) * (c + d) * n1 * n0
    return np.where(den > 0, (n0 + n1) * (a * d - b * c) ** 2 / np.maximum(den, 1), 0)


def _idf(n: np.ndarray, n_docs: int) -> np.ndarray:
    return 1 + np.log((1 + n_docs) / (1 + n))


def _sampled(docs: DataFrame, chosen: dict[int, tuple[str, int]], use: str) -> DataFrame:
    """(doc_id, toxic, text_hash, text): one text for each chosen id of a use."""
    rows = [(d, y) for d, (u, y) in chosen.items() if u == use]
    sample = docs.sparkSession.createDataFrame(rows, "doc_id long, toxic int")
    # bounded by EXAMPLES and CALIBRATION, so broadcast
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(sample), "doc_id").withColumn("text_hash", F.xxhash64("text"))
    return found.groupBy("doc_id", "toxic").agg(F.min("text_hash").alias("text_hash"), F.min_by("text", "text_hash").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, holdout: tuple[int, int] = (4, 2)) -> Model:
    """Learns from ``labels`` (doc_id, toxic) outside the part ``holdout`` = (parts, part) of
    crc32(doc_id as text), and from the texts of ``docs``.  The driver gets the examples' term
    counts, the terms in LEAST_SHARE of all documents, and one vote of each calibration row."""
    chosen = _pick(labels, holdout)
    rows = _sampled(docs, chosen, "example").select("doc_id", "text_hash", "text").mapInArrow(
        _counted, "doc_id long, text_hash long, terms array<long>, counts array<int>").toArrow()
    rows = rows.sort_by([("doc_id", "ascending")]).combine_chunks()
    flat = lambda name: rows[name].combine_chunks().flatten().to_numpy() if len(rows) else np.zeros(0, np.int64)
    ids, text_hash = rows["doc_id"].to_numpy(), rows["text_hash"].to_numpy()
    size = pc.list_value_length(rows["terms"]).to_numpy() if len(rows) else np.zeros(0, np.int64)
    hashes, number = np.unique(flat("terms").view(np.uint64), return_inverse=True)
    counts = Sparse(hashes, np.repeat(np.arange(len(ids)), size), number, flat("counts"))
    del rows
    toxic = np.array([chosen[d][1] for d in ids.tolist()], np.int64)
    # each text among the examples counts once, toxic where one of its labels is
    by = np.lexsort((1 - toxic, text_hash))
    once = np.zeros(len(ids), bool)
    once[by[np.flatnonzero(np.diff(text_hash[by], prepend=text_hash[by[:1]] - 1))]] = True
    at = once[counts.row]
    told = chi_squared(counts.term[at], toxic[counts.row[at]], len(hashes), int((1 - toxic[once]).sum()), int(toxic[once].sum()))

    n_docs = docs.count()
    least = max(1.0, LEAST_SHARE * n_docs)
    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_frequencies, "h long, n long")
    df = counted.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") > least).toArrow()
    held, n = df["h"].to_numpy().view(np.uint64), df["n"].to_numpy()
    del df
    by = np.argsort(held)
    model = Model(held[by], _idf(n[by], n_docs), float(_idf(least, n_docs)), hashes, np.where(told >= TELLING, told, 0.0), [],
                  [ids[toxic == y] for y in (0, 1)], np.zeros(0), np.zeros(0))
    vectors = model.vectors(counts, len(ids))
    model.index = [BlockMaxIndex([vectors[i] for i in np.flatnonzero(toxic == y)], len(hashes)) for y in (0, 1)]
    votes = _sampled(docs, chosen, "calibration").select("toxic", "text").mapInArrow(
        _votes(docs.sparkSession.sparkContext.broadcast(model)), "vote double, toxic int").toArrow()
    model.steps, model.rates = isotonic(votes["vote"].to_numpy(), votes["toxic"].to_numpy())
    return model


def _votes(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in slices(b, size=PART_BYTES)):
            vectors = model.value.vectors(term_counts(part["text"]), part.num_rows)
            yield pa.record_batch([pa.array([v for v, _ in model.value.votes(vectors)], pa.float64()), part["toxic"]], ["vote", "toxic"])

    return run


def _score(model: Broadcast, keep: list[str], read: str, evidence: bool):
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for part in (p for b in batches for p in slices(b, read, PART_BYTES)):
            vectors = own.vectors(term_counts(part[read]), part.num_rows)
            number: dict[bytes, int] = {}  # equal texts are compared once
            place = [number.setdefault(t.tobytes() + w.tobytes(), len(number)) for t, w in vectors]
            once = np.unique(np.array(place, np.int64), return_index=True)[1].tolist()
            each = own.votes([vectors[i] for i in once], SHOWN if evidence else 0)
            rates = np.array([own.rate(v) for v, _ in each])[place]
            results = [pa.array(rates, pa.float64()), pa.array(rates >= THRESHOLD).cast(pa.int32()), pa.array([each[i][1] for i in place], kind)]
            yield pa.record_batch([*(part[c] for c in keep), *results[:2 + evidence]], [*keep, *OUT[:2 + evidence]])

    return run


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, *, text: str = "text", evidence: bool = True) -> DataFrame:
    """``docs`` (all columns or those of ``keep``) with score (0 to 1), predicted (1 from
    THRESHOLD on) and evidence (of the nearest examples those whose votes weigh most, with cosine
    and label).  Only the column ``text`` is read for a score."""
    kept = [c for c in docs.columns if c not in OUT] if keep is None else keep
    read = text if docs.schema[text].dataType == T.StringType() else "_t_text"
    sent = docs.select(*kept, *([F.col(text).cast("string").alias(read)] if read not in kept else []))
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
                           *([T.StructField("evidence", EVIDENCE)] if evidence else [])])
    return sent.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model), kept, read, evidence), schema)
