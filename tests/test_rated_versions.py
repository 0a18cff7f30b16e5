"""Rate events on a versioned dimension: against a plain sequential model, with hot keys cut, and as
a stream cut into micro-batches."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimweave.operators.rates import FILL, OVERWRITE, rates_by_version
from dimweave.plans.catalogue import q26_rated_account_scd2
from dimweave.plans.jobs import account_rates
from dimweave.session import work_dir
from dimweave.streaming.jobs import account_stream_layout, run_account_stream, run_rated_account_stream
from test_streaming import _rows, cut_events, flat_events  # noqa: F401 - fixtures

VERSIONS = "id string, eff_seq bigint, end_seq bigint, rate decimal(38,10), note string"
EVENTS = "account_no string, seq bigint, rate decimal(38,10), source string"


def model(versions, events):
    """One event after the other on the row that holds then."""
    rows = [list(v) for v in versions]
    for key, seq, rate, source in sorted(events, key=lambda e: e[1]):
        for r in rows:
            if r[0] == key and r[1] <= seq and (r[2] is None or seq < r[2]) and rate is not None:
                if source == OVERWRITE or r[3] is None:
                    r[3] = rate
    return sorted(map(tuple, rows), key=str)


def check(spark, versions, events, chunk_rows):
    got = rates_by_version(spark.createDataFrame(versions, VERSIONS), spark.createDataFrame(events, EVENTS), key="account_no",
                           order=["seq"], dim_key="id", chunk_rows=chunk_rows)
    assert got.columns == ["id", "eff_seq", "end_seq", "rate", "note"]
    assert sorted([(r.id, r.eff_seq, r.end_seq, None if r.rate is None else int(r.rate), r.note) for r in got.collect()],
                  key=str) == model(versions, events)


def dec(rows):
    return [(*r[:3], None if r[3] is None else D(r[3]), r[4]) for r in rows]


@pytest.mark.parametrize("chunk_rows", [3, 1_000_000])
def test_sequential_model(spark, chunk_rows):
    rng = random.Random(5)
    versions, events, seq = [], [], iter(rng.sample(range(2000), 2000))
    for key in ["hot", "a", "b", None, ""]:
        begins = sorted(rng.sample(range(0, 2000, 7), 6 if key != "hot" else 40))
        for i, b in enumerate(begins):
            end = begins[i + 1] if i + 1 < len(begins) else (None if key != "b" else b + 50)
            versions.append((key, b, end, rng.choice([None, 7]), "n"))
    for key in ["hot"] * 150 + ["a", "b", None, "", "unknown"] * 25:
        rate = rng.choice([None, *range(100, 140)])
        events.append((key, next(seq), None if rate is None else D(rate), rng.choice([FILL, OVERWRITE])))
    check(spark, dec(versions), events, chunk_rows)


def test_bounds_ties_and_empty(spark):
    versions = dec([("a", 1, 5, None, "x"), ("a", 5, None, None, "x"), ("gone", 1, 3, 2, "x")])
    check(spark, versions, [("a", 5, D(9), OVERWRITE), ("a", 4, D(8), FILL), ("a", 0, D(1), OVERWRITE), ("gone", 3, D(1), OVERWRITE)], 1000)
    check(spark, versions, [], 1000)
    check(spark, [], [("a", 5, D(9), OVERWRITE)], 1000)


def test_null_account_takes_its_rate(spark):
    dim = spark.createDataFrame(dec([(None, 1, None, 2, "x"), ("a", 1, None, 3, "x")]), VERSIONS)
    events = spark.createDataFrame([(None, 4, D(9), OVERWRITE)], EVENTS)
    assert {r.id: int(r.rate) for r in account_rates(dim, events).collect()} == {None: 9, "a": 3}


def test_stream_in_four_batches_equals_batch(spark, flat_events):  # noqa: F811
    metrics = []
    store = run_rated_account_stream(spark, SF_SMALL, work_dir(spark, "t-s09"), source_dir=flat_events, glob="*.parquet",
                                     metrics=metrics, buckets=4)
    assert store.latest() == 4
    got = account_stream_layout(store.read_latest("dim"))
    assert _rows(got) == _rows(q26_rated_account_scd2(spark, SF_SMALL))
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").filter(F.col("event_type").isin("purchase", "click")).count()
    assert sum(m["rate_events"] for m in metrics) == events > sum(m["unmatched_rates"] for m in metrics)
    # a rate that came before a later batch closed its version is still there
    plain = account_stream_layout(run_account_stream(spark, SF_SMALL, work_dir(spark, "t-s09p"), source_dir=flat_events,
                                                     glob="*.parquet", buckets=4).read_latest("dim"))
    closed = lambda d: set(_rows(d.filter("end_seq > 200").select("account_no", "eff_seq", "rate")))
    assert closed(got) - closed(plain)
