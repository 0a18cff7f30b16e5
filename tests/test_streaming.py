"""Streams equal their batch twins when the events arrive cut into micro-batches; a
replayed batch changes nothing."""

import os
import posixpath
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimweave.plans.catalogue import q06_account_changes, q09_account_scd2
from dimweave.session import work_dir
from dimweave.streaming.jobs import (
    account_stream_layout,
    late_rows,
    run_account_stream,
    run_stateful_changes,
)


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def cut_events(spark):
    """events of sf0.001 cut into 4 files by event order, written one after another so
    the file source takes them in order."""
    d = tempfile.mkdtemp(prefix="dw-events-")
    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    bounds = [0, 200, 450, 700, 10**9]
    for i in range(4):
        part = ev.filter((F.col("event_id") >= bounds[i]) & (F.col("event_id") < bounds[i + 1]))
        part.coalesce(1).write.parquet(os.path.join(d, f"part{i}"))
        time.sleep(1.1)
    return d


def _part_files(d):
    files = []
    for i in range(4):
        sub = os.path.join(d, f"part{i}")
        files += [os.path.join(sub, f) for f in sorted(os.listdir(sub)) if f.endswith(".parquet")]
    return files


@pytest.fixture(scope="module")
def flat_events(cut_events):
    """One folder holding the four part files with increasing modification times."""
    d = tempfile.mkdtemp(prefix="dw-flat-")
    for i, f in enumerate(_part_files(cut_events)):
        target = os.path.join(d, f"events-{i}.parquet")
        with open(f, "rb") as src, open(target, "wb") as dst:
            dst.write(src.read())
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    return d


def test_account_stream_in_four_batches_equals_batch(spark, flat_events):
    root = work_dir(spark, "t-s01")
    metrics = []
    store = run_account_stream(spark, SF_SMALL, root, source_dir=flat_events, glob="*.parquet", metrics=metrics,
                               buckets=64)
    assert store.latest() == 4
    assert [m["batch"] for m in metrics] == [0, 1, 2, 3]
    got = account_stream_layout(store.read_latest("dim"))
    assert _rows(got) == _rows(q09_account_scd2(spark, SF_SMALL))


def test_replay_of_last_batch_changes_nothing(spark, flat_events):
    root = work_dir(spark, "t-s03")
    store = run_account_stream(spark, SF_SMALL, root, source_dir=flat_events, glob="*.parquet", buckets=8)
    first = _rows(account_stream_layout(store.read_latest("dim")))
    assert store.delete(posixpath.join(root, "checkpoint", "commits", "3"))
    store = run_account_stream(spark, SF_SMALL, root, source_dir=flat_events, glob="*.parquet")
    assert store.latest() == 4
    assert _rows(account_stream_layout(store.read_latest("dim"))) == first
    # restart without new data: nothing runs, nothing changes
    store = run_account_stream(spark, SF_SMALL, root, source_dir=flat_events, glob="*.parquet")
    assert store.latest() == 4


def test_stateful_changes_in_four_batches_equal_batch(spark, flat_events):
    out = run_stateful_changes(spark, SF_SMALL, work_dir(spark, "t-s02"), source_dir=flat_events,
                               glob="*.parquet")
    cols = ["seq", "id", "prt_code", "ccy", "op_type", "ts"]
    assert _rows(spark.read.parquet(out).select(cols)) == _rows(q06_account_changes(spark, SF_SMALL))


@pytest.fixture(scope="module")
def events_with_late_file(spark, flat_events):
    """The four in-order files plus a fifth that repeats old events (ids 100..149) with
    other values; in every key newer events have been applied before it arrives."""
    d = tempfile.mkdtemp(prefix="dw-late-")
    for f in sorted(os.listdir(flat_events)):
        with open(os.path.join(flat_events, f), "rb") as src, open(os.path.join(d, f), "wb") as dst:
            dst.write(src.read())
        mtime = os.stat(os.path.join(flat_events, f)).st_mtime
        os.utime(os.path.join(d, f), (mtime, mtime))
    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    old = (ev.filter((F.col("event_id") >= 100) & (F.col("event_id") < 150))
           .withColumn("event_type", F.lit("error")).withColumn("props", F.lit('{"k": 3}')))
    stage = tempfile.mkdtemp(prefix="dw-late-stage-")
    old.coalesce(1).write.mode("overwrite").parquet(stage)
    part = [f for f in os.listdir(stage) if f.endswith(".parquet")][0]
    target = os.path.join(d, "events-9.parquet")
    with open(os.path.join(stage, part), "rb") as src, open(target, "wb") as dst:
        dst.write(src.read())
    os.utime(target, (1_700_000_100, 1_700_000_100))
    return d, old.count()


def test_late_events_are_kept_aside(spark, events_with_late_file):
    d, n_old = events_with_late_file
    store = run_account_stream(spark, SF_SMALL, work_dir(spark, "t-late"), source_dir=d, glob="*.parquet", late="divert",
                               metrics=(metrics := []))
    assert store.latest() == 5
    assert store.read(5, "late").count() == late_rows(store).count() == n_old == sum(m["late_rows"] for m in metrics)
    got = account_stream_layout(store.read_latest("dim"))
    assert _rows(got) == _rows(q09_account_scd2(spark, SF_SMALL))


def test_late_product_events_are_kept_aside(spark, events_with_late_file):
    from dimweave.plans.catalogue import q12_product_scd2
    from dimweave.streaming.loaders import product_stream_layout, run_product_stream

    d, n_old = events_with_late_file
    store = run_product_stream(spark, SF_SMALL, work_dir(spark, "t-late-p"), source_dir=d, glob="*.parquet", late="divert")
    assert store.latest() == 5
    assert store.read(5, "late").count() == n_old
    got = product_stream_layout(store.read_latest("dim"))
    assert _rows(got) == _rows(q12_product_scd2(spark, SF_SMALL))


def test_versions_rewrite_only_touched_buckets(spark, flat_events):
    root = work_dir(spark, "t-buckets")
    store = run_account_stream(spark, SF_SMALL, root, source_dir=flat_events, glob="*.parquet", buckets=64)
    m = store.manifest(4)["dim"]["buckets"]
    versions = set(m.values())
    assert 0 in versions and max(versions) == 4  # seed-only buckets never rewritten
    touched_last = store._listed_buckets(store._data_path("dim", 4))
    keys_last = spark.read.parquet(_part_files_flat(flat_events)[-1]).select(F.col("user_id").alias("id"))
    assert touched_last == set(store.touched_buckets(keys_last))
    assert len(touched_last) < store.buckets


def _part_files_flat(d):
    return [os.path.join(d, f) for f in sorted(os.listdir(d))]


def test_product_stream_in_four_batches_equals_batch(spark, flat_events):
    from dimweave.plans.catalogue import q12_product_scd2
    from dimweave.streaming.loaders import product_stream_layout, run_product_stream

    store = run_product_stream(spark, SF_SMALL, work_dir(spark, "t-s04"), source_dir=flat_events, glob="*.parquet",
                               buckets=16)
    assert store.latest() == 4
    dim = store.read_latest("dim")
    got = product_stream_layout(dim)
    assert _rows(got) == _rows(q12_product_scd2(spark, SF_SMALL))
    # every new version got a key from one sequence: dense, unique, continued over batches
    ids = sorted(r.pd_dim_id for r in dim.filter(F.col("loaded")).select("pd_dim_id").collect())
    assert ids == list(range(1, len(ids) + 1))
    assert store.value(4, "next_pd_dim_id", 0) == len(ids) + 1
    assert dim.filter(~F.col("loaded") & F.col("pd_dim_id").isNotNull()).count() == 0


def test_rate_stream_in_four_batches_equals_batch(spark, flat_events):
    from dimweave.plans import fixtures as fx
    from dimweave.plans.catalogue import q13_rate_inputs, q14_rates_before, q15_rates_final
    from dimweave.streaming.loaders import rate_stream_before, run_rate_stream

    metrics = []
    store = run_rate_stream(spark, SF_SMALL, work_dir(spark, "t-s05"), source_dir=flat_events, glob="*.parquet",
                            buckets=16, metrics=metrics)
    assert store.latest() == 4
    ev = q13_rate_inputs(spark, SF_SMALL)
    unknown = ev.join(fx.fx_rate_dim(spark, SF_SMALL), "account_no", "left_anti").count()
    assert sum(m["events"] for m in metrics) == ev.count()
    assert sum(m["unknown_account_events"] for m in metrics) == unknown > 0
    final = store.read_latest("rates").select("account_no", F.col("rate").cast("double").alias("rate"))
    assert _rows(final) == _rows(q15_rates_final(spark, SF_SMALL))
    before = rate_stream_before(store).select(
        "seq", "account_no", "source", F.col("rate").cast("double").alias("rate"),
        F.col("rate_before").cast("double").alias("rate_before"))
    assert _rows(before) == _rows(q14_rates_before(spark, SF_SMALL))


def test_fact_stream_in_batches_equals_batch(spark):
    from dimweave.plans.catalogue import q17_fact_rows
    from dimweave.streaming.loaders import run_fact_stream

    orders = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    d = tempfile.mkdtemp(prefix="dw-orders-")
    orders.repartition(3).write.mode("overwrite").parquet(d)
    out = run_fact_stream(spark, SF_SMALL, work_dir(spark, "t-s06"), source_dir=d, glob="*.parquet")
    assert _rows(spark.read.parquet(out)) == _rows(q17_fact_rows(spark, SF_SMALL))


def test_processing_time_trigger_keeps_running(spark, flat_events):
    from dimweave.streaming.loaders import run_fact_stream

    before = {q.id for q in spark.streams.active}
    out = run_fact_stream(spark, SF_SMALL, work_dir(spark, "t-cont"), source_dir=flat_events, glob="none-*",
                          trigger={"processingTime": "1 second"})
    running = [q for q in spark.streams.active if q.id not in before]
    assert len(running) == 1 and running[0].isActive
    running[0].stop()
    assert out.endswith("facts")


def test_account_stream_with_hot_key_chunks_equals_batch(spark, flat_events, small_chunks):
    """Every key hot (chunks of 7 rows): the prior-event rows carried between batches
    go through the chunked path and the result still equals one batch."""
    store = run_account_stream(spark, SF_SMALL, work_dir(spark, "t-s01-hot"), source_dir=flat_events,
                               glob="*.parquet")
    got = account_stream_layout(store.read_latest("dim"))
    assert _rows(got) == _rows(q09_account_scd2(spark, SF_SMALL))


def test_product_stream_with_hot_key_chunks_equals_batch(spark, flat_events, small_chunks):
    from dimweave.plans.catalogue import q12_product_scd2
    from dimweave.streaming.loaders import product_stream_layout, run_product_stream

    store = run_product_stream(spark, SF_SMALL, work_dir(spark, "t-s04-hot"), source_dir=flat_events,
                               glob="*.parquet")
    got = product_stream_layout(store.read_latest("dim"))
    assert _rows(got) == _rows(q12_product_scd2(spark, SF_SMALL))


def test_late_events_are_applied_in_arrival_order(spark, events_with_late_file):
    """By default a batch's rows follow whatever its keys already hold, however old they are."""
    from dimweave.plans import fixtures as fx

    d, n_old = events_with_late_file
    store = run_account_stream(spark, SF_SMALL, work_dir(spark, "t-arrival"), source_dir=d, glob="*.parquet")
    dim = store.read_latest("dim")
    files = _part_files_flat(d)
    last, versions = {}, 0
    for f in files:
        ev = fx.account_events_from(spark.read.parquet(f)).orderBy("seq").collect()
        for r in ev:
            v = tuple(r[c] for c in r.__fields__ if c not in ("seq", "ts", "id"))
            if last.get(r.id) != v:
                versions += 1
            last[r.id] = v
    assert dim.filter(F.col("loaded")).count() == versions
    # one open version per loaded key, made by its last event in arrival order
    ends = dim.filter(F.col("loaded") & F.col("end_seq").isNull()).groupBy("id").count().collect()
    assert len(ends) == len(last) and all(r["count"] == 1 for r in ends)


def test_stream_reads_a_folder_of_part_files(spark, tmp_path):
    for t in ("events", "customer", "supplier"):
        spark.read.parquet(os.path.join(SF_SMALL, f"{t}.parquet")).repartition(3).write.parquet(str(tmp_path / f"{t}.parquet"))
    store = run_account_stream(spark, str(tmp_path), work_dir(spark, "t-folder"), max_files_per_trigger=10)
    assert _rows(account_stream_layout(store.read_latest("dim"))) == _rows(q09_account_scd2(spark, SF_SMALL))


def test_state_keeps_large_numbers_and_nulls(spark, tmp_path):
    from dimweave.streaming.jobs import stateful_changes

    big = 2**53
    rows = [(1, 1, big), (1, 2, big + 1), (1, 3, None), (1, 4, None), (1, 5, big + 1), (2, 6, None), (None, 7, 3), (None, 8, 3)]
    schema = "k long, seq long, v long"
    for i in range(2):
        spark.createDataFrame(rows[4 * i:4 * i + 4], schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = (stateful_changes(src, "k", ["seq"], ["v"]).writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(r.seq for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [1, 2, 3, 5, 6, 7]
