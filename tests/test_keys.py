"""Surrogate keys: dense, unique, in (bucket, key, order) order, hot key included."""

import random

import pytest
from pyspark.sql import functions as F

from dimweave.operators.keys import assign_surrogate_keys


@pytest.mark.parametrize("chunk_rows", [3, 1_000_000])
def test_dense_unique_ordered(spark, chunk_rows):
    rnd = random.Random(5)
    rows = [(0 if rnd.random() < 0.4 else rnd.randint(1, 50), i) for i in range(800)]
    df = spark.createDataFrame(rows, "k long, seq long")
    got = assign_surrogate_keys(df, "k", ["seq"], out="sk", start=100, buckets=4, chunk_rows=chunk_rows)
    res = sorted((r.sk, r.k, r.seq) for r in got.collect())
    expected = sorted(rows, key=lambda r: (r[0] % 4, r[0], r[1]))
    assert [sk for sk, _, _ in res] == list(range(100, 100 + len(rows)))
    assert [(k, s) for _, k, s in res] == expected


def test_text_and_null_keys_are_numbered(spark):
    rows = [("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5)]
    df = spark.createDataFrame(rows, "k string, o long")
    out = assign_surrogate_keys(df, "k", ["o"], out="sk", start=10, buckets=3).collect()
    assert sorted(r.sk for r in out) == [10, 11, 12, 13, 14]
    assert {(r.k, r.o) for r in out} == set(rows)
    nulls = sorted((r.o, r.sk) for r in out if r.k is None)
    assert nulls[1][1] == nulls[0][1] + 1


def test_rows_are_numbered_without_a_window_over_them(spark):
    """A hot key's rows lie in several partitions, each near ``chunk_rows``; the only window runs over
    one count for each partition."""
    df = spark.range(4000).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id AS seq", "CONCAT('t', id) AS note")
    out = assign_surrogate_keys(df, "k", ["seq"], out="sk", chunk_rows=200)
    assert out.columns == ["sk", "k", "seq", "note"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "windowspecdefinition(_dw_part" in plan
    rows = out.collect()
    assert sorted(r.sk for r in rows) == list(range(1, 4001)) and all(r.note == f"t{r.seq}" for r in rows)
    hot = sorted((r.seq, r.sk) for r in rows if r.k == -1)
    assert [sk - hot[0][1] for _, sk in hot] == list(range(len(hot)))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 600


def test_no_rows(spark):
    assert assign_surrogate_keys(spark.range(0).withColumnRenamed("id", "k"), "k", ["k"], out="sk").count() == 0
