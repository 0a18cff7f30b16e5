"""Change points of one large key: time grows with the rows, not with their square."""

import time

from pyspark.sql import functions as F

from dimweave.operators.changes import change_points


def _seconds(spark, n):
    df = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("seq"), F.col("id").alias("v"))
    t = time.perf_counter()
    r = change_points(df, ["k"], ["seq"], ["v"], bounds=["seq"]).agg(
        F.count("*").alias("n"), F.sum(F.col("_dw_next.seq") - F.col("seq")).alias("s")).collect()[0]
    assert (r.n, r.s) == (n, n - 1)
    return time.perf_counter() - t


def test_one_key_with_a_million_changing_rows(spark):
    _seconds(spark, 1_000)
    small, large = _seconds(spark, 50_000), _seconds(spark, 800_000)
    assert large < 16 * (small + 2)


def test_lookup_joins_once_and_splits_hot_keys(spark):
    from dimweave.operators.lookups import Lookup, priority_lookup

    a = spark.createDataFrame([(1, None), (2, 5.0)], "id long, v double")
    b = spark.createDataFrame([(1, 7.0), (3, 9.0), (3, 8.0)], "id long, v double")
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "k long")
    x = priority_lookup(df, "k", [Lookup(a, "id", F.col("v")), Lookup(b, "id", F.col("v"))], "out")
    assert sorted(((r.k, r.out) for r in x.collect()), key=str) == sorted(
        [(1, None), (2, 5.0), (3, 8.0), (4, None), (None, None)], key=str)
    assert x._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1
