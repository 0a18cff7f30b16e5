"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

Vectors become sparse integer rows (term = component number, weight = floor(scale * x)).  The
candidates of a block are inverted into one posting list for each term; a query scatters
``its weight * posting weights`` into a dense score array with one cell for each candidate of
the block, and a partition selection keeps the block's k best.  Blocks are merged by rank.

Queries and candidates are dealt into blocks of bounded size and each query block meets each
candidate block once, as one group of a co-group, so a task holds two blocks at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATE_BLOCK, QUERY_BLOCK = 32_768, 4_096
OUT = "query_id long, vec_id long, score long"
#: Below this bound on the sum of the absolute products, sums of longs are exact.
SAFE = 2.0**62
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def usable(vector: Column) -> Column:
    """Not null, and no component null or non-finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _sparse(col: pa.ListArray, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight as whole double) of the non-zero weights."""
    flat = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = np.diff(col.offsets.to_numpy())
    w = np.floor(scale * flat)
    row = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = w != 0
    return row[keep], term[keep], w[keep]


def _block(scale: float, k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        queries, rows = queries.combine_chunks(), rows.combine_chunks()
        none = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                         "score": pa.array([], pa.int64())})
        if not queries.num_rows or not rows.num_rows:
            return none
        ids = rows["id"].to_numpy()
        by_id = np.argsort(ids, kind="stable")  # ties go to the smaller id, so cells are in id order
        rank = np.empty(len(ids), np.int64)
        rank[by_id] = np.arange(len(ids))
        ids = ids[by_id]
        r, t, w = _sparse(rows["v"].chunk(0), scale)
        r = rank[r]
        qr, qt, qw = _sparse(queries["v"].chunk(0), scale)
        terms = max(t.max(initial=-1), qt.max(initial=-1)) + 1
        exact = terms * np.abs(w).max(initial=0) * np.abs(qw).max(initial=0) < SAFE
        whole = (lambda x: x.astype(np.int64)) if exact else (lambda x: np.array([int(y) for y in x], object))
        order = np.lexsort((r, t))
        lists = np.split(order, np.searchsorted(t[order], np.arange(1, terms)))
        postings = [(r[x], whole(w[x])) for x in lists]
        cuts = np.searchsorted(qr, np.arange(queries.num_rows + 1))
        out = []
        for i, q in enumerate(queries["id"].to_pylist()):
            score = np.zeros(len(ids), np.int64 if exact else object)
            for term, weight in zip(qt[cuts[i]:cuts[i + 1]], whole(qw[cuts[i]:cuts[i + 1]])):
                at, v = postings[term]
                score[at] += weight * v
            if not exact:
                score = np.array([min(max(x, LONG_MIN), LONG_MAX) for x in score], np.int64)
            others = np.flatnonzero(ids != q)
            s = score[others]
            if len(s) > k:
                least = np.partition(s, len(s) - k)[len(s) - k]
                over, tied = np.flatnonzero(s > least), np.flatnonzero(s == least)
                best = np.concatenate([over, tied[:k - len(over)]])
            else:
                best = np.arange(len(s))
            out.append((np.full(len(best), q, np.int64), ids[others[best]], s[best]))
        return pa.table({n: np.concatenate([o[j] for o in out]) for j, n in enumerate(("query_id", "vec_id", "score"))})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, *, id: str, vector: str, k: int = 5, scale: float = 256.0,
          candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores, ties to the smaller id.

    A score is the inner product of floor(scale * component), components as double; shorter
    vectors count as padded with zeros.  A row's own id is no candidate for it.  Vectors that
    are null or hold null or non-finite components take no part; a query with fewer than k
    candidates gets them all, one without candidates none.  Rows that repeat an id count as one
    row (the one with the smallest vector).  Sums beyond the range of a long end at its limit.
    """
    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"))
        df = df.filter(F.col("id").isNotNull() & usable(F.col("v")))
        return df.groupBy("id").agg(F.min("v").alias("v"))

    rows, asked = clean(vectors), clean(queries)
    sizes = {"c": rows.count(), "q": asked.count()}
    n_c, n_q = -(-sizes["c"] // candidate_block) or 1, -(-sizes["q"] // query_block) or 1
    # every candidate block meets every query block once
    deal = lambda df, n: F.pmod(F.xxhash64(F.lit(7), F.col("id")), F.lit(n)).cast("int")
    c = rows.select("id", "v", deal(rows, n_c).alias("cb"), F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"))
    q = asked.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("cb"), deal(asked, n_q).alias("qb"))
    part = (q.groupBy("cb", "qb").cogroup(c.groupBy("cb", "qb"))
            .applyInArrow(lambda a, b: _block(scale, k)(a.select(["id", "v"]), b.select(["id", "v"])), OUT))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (part.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
