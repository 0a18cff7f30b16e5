"""Product, rate and teller loads from message text: cut into micro-batches, with dead letters, and
with a batch that runs again."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimweave.plans import fixtures as fx
from dimweave.session import work_dir
from dimweave.sources.messages import decode
from dimweave.streaming.jobs import table_stream
from dimweave.streaming.loaders import (
    product_stream_layout,
    run_fact_messages,
    run_product_messages,
    run_rate_messages,
)
from dimweave.streaming.queries import STREAM_SQL
from test_streaming import cut_events, flat_events  # noqa: F401 - fixtures


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "orders", "customer", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def same(duck, df, name):
    rel = duck.sql(STREAM_SQL[name])
    cols = sorted(rel.columns)
    assert sorted(df.columns) == cols
    flat = lambda rows, names: sorted(tuple(str(r[names.index(c)]) for c in cols) for r in rows)
    assert flat([tuple(r) for r in df.collect()], df.columns) == flat(rel.fetchall(), rel.columns)


def source(spark, folder):
    return table_stream(spark, SF_SMALL, "events", source_dir=folder, glob="*.parquet")


def test_products_in_four_batches(spark, duck, flat_events):  # noqa: F811
    store, dead = run_product_messages(spark, fx.product_messages_from(source(spark, flat_events)), SF_SMALL, work_dir(spark, "t-s10"),
                                       buckets=4, retain=2)
    assert store.latest() == 4
    same(duck, product_stream_layout(store.read_latest("dim")), "s10_product_messages")
    reasons = {r.reason: r["count"] for r in spark.read.parquet(dead).groupBy("reason").count().collect()}
    n = lambda c: duck.sql(f"SELECT count(*) FROM events WHERE {c}").fetchall()[0][0]
    assert reasons == {"malformed": n("event_id % 50 = 0"), "null": n("event_id % 49 = 0 AND event_id % 50 <> 0"),
                       "missing:productNo": n("event_id % 47 = 0 AND event_id % 49 <> 0 AND event_id % 50 <> 0")}


def test_rates_of_both_sources_in_four_batches(spark, duck, flat_events):  # noqa: F811
    metrics = []
    ow = fx.rate_messages_from(source(spark, flat_events), "purchase", "id", "interestNumber")
    fl = fx.rate_messages_from(source(spark, flat_events), "click", "accountNumber", "crIntRate")
    store, dead = run_rate_messages(spark, ow, fl, SF_SMALL, work_dir(spark, "t-s11"), buckets=4, metrics=metrics)
    assert store.latest() == 4
    same(duck, store.read_latest("rates").select("account_no", F.col("rate").cast("double").alias("rate")), "s11_rate_messages")
    lost = spark.read.parquet(dead)
    same(duck, lost.select("entity", "seq", "reason"), "s13_rate_dead_letters")
    events = duck.sql("SELECT count(*) FROM events WHERE event_type IN ('purchase', 'click')").fetchall()[0][0]
    assert sum(m["events"] for m in metrics) + lost.count() == events


def test_facts_and_a_batch_that_runs_again(spark, duck, tmp_path):
    folder = tmp_path / "orders"
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartition(3).write.parquet(str(folder))
    root, metrics = work_dir(spark, "t-s12"), []

    def load():
        orders = table_stream(spark, SF_SMALL, "orders", source_dir=str(folder), glob="*.parquet")
        return run_fact_messages(spark, fx.teller_messages_from(orders), SF_SMALL, root, metrics=metrics)

    facts, dead = load()
    rows = spark.read.parquet(facts)
    assert rows.select("batch").distinct().count() == 3 and sum(m["rows"] for m in metrics) == rows.count()
    same(duck, rows.drop("batch"), "s12_teller_messages")
    before = spark.read.parquet(dead).count()
    commits = os.path.join(root.replace("file:", ""), "checkpoint", "commits")
    for name in ("2", ".2.crc"):
        os.remove(os.path.join(commits, name))
    load()
    same(duck, spark.read.parquet(facts).drop("batch"), "s12_teller_messages")
    assert spark.read.parquet(dead).count() == before > 0


def test_a_field_that_cannot_be_read_is_a_dead_letter(spark):
    rows = [(1, '{"id": "7", "n": 1}'), (2, '{"id": "seven"}'), (3, '{"id": null}'), (4, '{"id": "99999999999999999999"}'), (5, '{"id": ""}')]
    df = spark.createDataFrame(rows, "k int, value string")
    schema = spark.createDataFrame([], "id string, n int").schema
    good, dead = decode(df, "value", schema, keep=["k"], typed={"id": "bigint"})
    assert {tuple(r) for r in good.collect()} == {(1, 7, 1), (3, None, None)} and dict(good.dtypes)["id"] == "bigint"
    assert {(r.k, r.reason) for r in dead.collect()} == {(k, "unreadable:id") for k in (2, 4, 5)}
