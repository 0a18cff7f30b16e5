import math
import random

import pytest

from dimweave.llm import topk


def brute(rows, k):
    clean = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean[i] = min(clean.get(i, v), v)
    w = {i: [math.floor(256 * x) for x in v] for i, v in clean.items()}
    out = []
    for q in w:
        if q % 5 == 0:
            best = sorted((-sum(a * b for a, b in zip(w[q], c)), i) for i, c in w.items() if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(32_768, 4_096), (7, 3)])
def test_matches_all_pairs(spark, blocks):
    rnd = random.Random(3)
    rows = [(i, [round(rnd.uniform(-1, 1), 2) for _ in range(rnd.choice([4, 4, 4, 2, 0]))]) for i in range(60)]
    rows += [(60, None), (65, [1.0, None]), (70, [float("nan")]), (75, [float("inf"), 1.0]), (None, [1.0]), (5, rows[5][1]),
             (80, rows[10][1]), (81, rows[10][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string").repartition(3)
    got = topk.top_k(df, df.filter("vec_id % 5 = 0"), id="vec_id", vector="embedding", k=5, candidate_block=blocks[0], query_block=blocks[1])
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_few_candidates_and_large_numbers(spark):
    df = spark.createDataFrame([(0, [1e9, 1.0]), (1, [1e9, 2.0]), (5, [-1e30, 0.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(df, df.filter("vec_id % 5 = 0"), id="vec_id", vector="embedding").collect()}
    assert got[(0, 5)] == topk.LONG_MIN  # beyond a long: its limit
    assert got[(0, 1)] == min((256 * 10**9) ** 2 + 256 * 512, topk.LONG_MAX)
    none = df.limit(0)
    assert topk.top_k(none, none, id="vec_id", vector="embedding").count() == 0
