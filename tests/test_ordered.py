"""The chunked keyed scan equals a plain per-key loop, hot keys included."""

import random

import pytest
from pyspark.sql import functions as F

from dimweave.operators.ordered import CHUNK, drop_scan_columns, keyed_scan


def _model(rows):
    by_key = {}
    for k, seq, v in sorted(rows, key=lambda r: r[1]):
        by_key.setdefault(k, []).append((seq, v))
    out = {}
    for k, items in by_key.items():
        vals = [v for _, v in items]
        for i, (seq, v) in enumerate(items):
            before = [x for x in vals[:i] if x is not None]
            out[seq] = (vals[i - 1] if i else None, vals[i + 1] if i + 1 < len(vals) else None,
                        before[-1] if before else None, before[0] if before else None)
    return out


@pytest.mark.parametrize("chunk_rows,seed", [(5, 1), (50, 2), (10_000, 3)])
def test_scan_matches_loop(spark, chunk_rows, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(1500):
        k = 0 if rnd.random() < 0.35 else rnd.randint(1, 40)  # key 0 holds a third of the rows
        rows.append((k, i * 2 + rnd.randint(0, 1), None if rnd.random() < 0.3 else rnd.randint(0, 4)))
    df = spark.createDataFrame(rows, "k long, seq long, v int")
    v = F.col("v")
    out = keyed_scan(df, ["k"], ["seq"], prev={"p": v}, next={"n": v}, last_before={"lb": v},
                     first_before={"fb": v}, chunk_rows=chunk_rows)
    if chunk_rows == 5:
        assert out.select(CHUNK).distinct().count() > 20
    got = {r.seq: (r.p, r.n, r.lb, r.fb) for r in drop_scan_columns(out).collect()}
    assert got == _model(rows)


def test_timestamp_order(spark):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [(1, base + dt.timedelta(seconds=i), i) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, v int")
    out = drop_scan_columns(keyed_scan(df, ["k"], ["ts"], prev={"p": F.col("v")}, chunk_rows=3))
    got = sorted((r.v, r.p) for r in out.collect())
    assert got == [(i, i - 1 if i else None) for i in range(40)]


def test_sampled_hot_key_detection(spark):
    """chunk_rows above the sample threshold: hot keys are found on a sample, the
    result still equals a plain per-key window on every row."""
    from pyspark.sql import Window

    n = 120_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
        F.col("id").alias("seq"), (F.col("id") * 7 % 11).cast("int").alias("v"))
    out = keyed_scan(df, ["k"], ["seq"], prev={"p": F.col("v")}, last_before={"lb": F.when(F.col("v") > 8, F.col("v"))},
                     chunk_rows=20_000)
    assert out.filter(F.col("_dw_hot")).select(CHUNK).distinct().count() >= 2
    w = Window.partitionBy("k").orderBy("seq")
    ref = df.select("seq", F.lag("v").over(w).alias("p"),
                    F.last(F.when(F.col("v") > 8, F.col("v")), ignorenulls=True)
                    .over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("lb"))
    got = drop_scan_columns(out).select("seq", "p", "lb")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_null_key_is_a_key(spark):
    """Rows with a null key form one ordered group, also when that group is hot."""
    rows = [(None if i % 2 == 0 else i % 3, i, i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, seq long, v int")
    for chunk_rows in (10, 1_000_000):
        out = drop_scan_columns(keyed_scan(df, ["k"], ["seq"], prev={"p": F.col("v")}, chunk_rows=chunk_rows))
        got = {r.seq: r.p for r in out.collect()}
        exp = {}
        last = {}
        for k, seq, v in rows:
            exp[seq] = last.get(k)
            last[k] = v
        assert got == exp


def test_null_order_sorts_first_in_hot_key(spark):
    rows = [(1, None if i < 3 else i, i) for i in range(60)]  # three rows without an order value
    df = spark.createDataFrame(rows, "k long, seq long, v int")
    out = drop_scan_columns(keyed_scan(df, ["k"], ["seq", "v"], prev={"p": F.col("v")}, chunk_rows=5))
    got = {r.v: r.p for r in out.collect()}
    assert got == {v: (v - 1 if v else None) for v in range(60)}


def test_beyond_the_broadcast_bound_joins_without_broadcast(spark, monkeypatch):
    """More hot chunks than the broadcast bound: same rows, plain joins instead."""
    import dimweave.operators.ordered as ordered

    monkeypatch.setattr(ordered, "MAX_BROADCAST_CHUNKS", 1)
    rows = [(i % 3, i, i % 5) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, seq long, v int")
    out = keyed_scan(df, ["k"], ["seq"], prev={"p": F.col("v")}, next={"n": F.col("v")}, chunk_rows=20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan
    got = {r.seq: (r.p, r.n) for r in drop_scan_columns(out).collect()}
    assert got == _model_pn(rows)


def _model_pn(rows):
    m = _model(rows)
    return {seq: (p, n) for seq, (p, n, _, _) in m.items()}


def test_text_order(spark):
    """A text order column has no width to cut by: a hot key stays in one piece, with the same rows."""
    rows = [(1, f"{i:03d}", i) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, seq string, v int")
    out = drop_scan_columns(keyed_scan(df, ["k"], ["seq"], prev={"p": F.col("v")}, chunk_rows=5))
    assert {r.v: r.p for r in out.collect()} == {v: (v - 1 if v else None) for v in range(60)}
