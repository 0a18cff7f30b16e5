"""Chunks of hot keys: equal ranks of the order tuple, whatever its spread and type."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dimweave.operators import ordered
from dimweave.operators.ordered import CHUNK, assign_chunks


def rows_with(spread: str, n: int) -> list:
    rng = random.Random(4)
    if spread == "outlier":  # one value far from the rest
        return [*range(n - 1), 10**15]
    if spread == "burst":  # nine tenths within a hundredth of the range
        return [i if i % 10 else i * 1_000 for i in range(n)]
    if spread == "text":
        return [f"{rng.choice('abc')}{i:06d}" for i in range(n)]
    if spread == "time":
        return [dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=i * i) for i in range(n)]
    return [None, *range(n - 1)]  # a null comes first


@pytest.mark.parametrize("spread", ["outlier", "burst", "text", "time", "null"])
@pytest.mark.parametrize("chunk_rows", [7, 300])
def test_groups_stay_under_twice_the_chunk_rows(spark, spread, chunk_rows):
    values = rows_with(spread, 6_000)
    df = spark.createDataFrame([("hot", v, i) for i, v in enumerate(values)] + [(k, v, 0) for k in ("cold", None) for v in values[:5]],
                               f"k string, o {spark.createDataFrame([(values[-1],)], ['o']).dtypes[0][1]}, i int").repartition(5)
    out = assign_chunks(df, ["k"], ["o", "i"], chunk_rows).select("k", "o", "i", CHUNK).collect()
    assert len(out) == 6_010 and all(r[CHUNK] is None for r in out if r.k != "hot")
    hot = sorted((r for r in out if r.k == "hot"), key=lambda r: (r.o is not None, r.o if r.o is not None else 0, r.i) if spread == "null" else (r.o, r.i))
    chunks = [r[CHUNK] for r in hot]
    assert chunks == sorted(chunks)  # never decreases along the order
    sizes = [chunks.count(c) for c in set(chunks)]
    assert max(sizes) < 2 * chunk_rows and len(sizes) >= 6_000 / (2 * chunk_rows)


def test_ties_in_the_first_column_are_cut_by_the_next(spark):
    df = spark.range(4_000).select(F.lit(1).alias("k"), F.lit("same day").alias("o"), F.col("id").alias("i"))
    sizes = [r["count"] for r in assign_chunks(df, ["k"], ["o", "i"], 100).groupBy(CHUNK).count().collect()]
    assert max(sizes) < 200 and sum(sizes) == 4_000


def test_a_deep_tree_and_no_broadcast(spark, monkeypatch):
    df = spark.range(3_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    plain = sorted(map(tuple, assign_chunks(df, ["k"], ["o"], 10).collect()))
    monkeypatch.setattr(ordered, "FAN", 3)
    monkeypatch.setattr(ordered, "MAX_BROADCAST_CHUNKS", 1)
    assert sorted(map(tuple, assign_chunks(df, ["k"], ["o"], 10).collect())) == plain
    assert len({r[2] for r in plain}) == 150
