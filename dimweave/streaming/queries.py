"""Registered stream queries (each runs its stream to the end of the given input and
returns the resulting table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.plans import fixtures as fx
from dimweave.plans.catalogue import ORACLE_SQL, account_messages_sql
from dimweave.session import work_dir
from dimweave.streaming.jobs import (
    account_stream_layout,
    run_account_messages,
    run_account_stream,
    run_rated_account_stream,
    run_stateful_changes,
    table_stream,
)
from dimweave.streaming.loaders import (
    product_stream_layout,
    rate_stream_before,
    run_fact_messages,
    run_fact_stream,
    run_product_messages,
    run_product_stream,
    run_rate_messages,
    run_rate_stream,
)


def s01_account_stream(spark: SparkSession, d: str) -> DataFrame:
    store = run_account_stream(spark, d, work_dir(spark, "s01"))
    return account_stream_layout(store.read_latest("dim"))


def s02_stateful_changes(spark: SparkSession, d: str) -> DataFrame:
    changes = spark.read.parquet(run_stateful_changes(spark, d, work_dir(spark, "s02")))
    return changes.select("seq", "id", "prt_code", "ccy", "op_type", "ts")


def s04_product_stream(spark: SparkSession, d: str) -> DataFrame:
    store = run_product_stream(spark, d, work_dir(spark, "s04"))
    return product_stream_layout(store.read_latest("dim"))


def s05_rate_stream(spark: SparkSession, d: str) -> DataFrame:
    store = run_rate_stream(spark, d, work_dir(spark, "s05"))
    return store.read_latest("rates").select("account_no", F.col("rate").cast("double").alias("rate"))


def s05b_rates_before(spark: SparkSession, d: str) -> DataFrame:
    r = rate_stream_before(run_rate_stream(spark, d, work_dir(spark, "s05b")))
    return r.select("seq", "account_no", "source", F.col("rate").cast("double").alias("rate"),
                    F.col("rate_before").cast("double").alias("rate_before"))


def _messages(spark: SparkSession, d: str) -> DataFrame:
    events = table_stream(spark, d, "events")
    return fx.account_messages_from(events).select("value", F.col("key").cast("bigint").alias("seq"),
                                                   F.timestamp_seconds(F.col("key").cast("bigint")).cast("timestamp_ntz").alias("ts"))


def s07_account_messages(spark: SparkSession, d: str) -> DataFrame:
    """From message text to the account dimension."""
    store, _ = run_account_messages(spark, _messages(spark, d), d, work_dir(spark, "s07"))
    return account_stream_layout(store.read_latest("dim")).select("account_no", "account_type", "ccy", "rate", "record_stat",
                                                                  "account_class", "eff_seq", "end_seq", "is_new")


def s08_account_dead_letters(spark: SparkSession, d: str) -> DataFrame:
    """The same load's dead letters."""
    _, folder = run_account_messages(spark, _messages(spark, d), d, work_dir(spark, "s08"))
    return spark.read.parquet(folder).select("seq", "reason")


def s09_rated_account_stream(spark: SparkSession, d: str) -> DataFrame:
    """Account and rate streams on one dimension."""
    store = run_rated_account_stream(spark, d, work_dir(spark, "s09"))
    return account_stream_layout(store.read_latest("dim"))


def s06_fact_stream(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(run_fact_stream(spark, d, work_dir(spark, "s06")))


def _rate_messages(spark: SparkSession, d: str, name: str):
    ow = fx.rate_messages_from(table_stream(spark, d, "events"), "purchase", "id", "interestNumber")
    fl = fx.rate_messages_from(table_stream(spark, d, "events"), "click", "accountNumber", "crIntRate")
    return run_rate_messages(spark, ow, fl, d, work_dir(spark, name))


def s10_product_messages(spark: SparkSession, d: str) -> DataFrame:
    """From message text to the product dimension."""
    store, _ = run_product_messages(spark, fx.product_messages_from(table_stream(spark, d, "events")), d, work_dir(spark, "s10"))
    return product_stream_layout(store.read_latest("dim"))


def s11_rate_messages(spark: SparkSession, d: str) -> DataFrame:
    """From the message text of both rate sources to the rates."""
    store, _ = _rate_messages(spark, d, "s11")
    return store.read_latest("rates").select("account_no", F.col("rate").cast("double").alias("rate"))


def s12_teller_messages(spark: SparkSession, d: str) -> DataFrame:
    """From message text to fact rows."""
    facts, _ = run_fact_messages(spark, fx.teller_messages_from(table_stream(spark, d, "orders")), d, work_dir(spark, "s12"))
    return spark.read.parquet(facts).drop("batch")


def s13_rate_dead_letters(spark: SparkSession, d: str) -> DataFrame:
    """The rate load's dead letters, of both sources."""
    _, dead = _rate_messages(spark, d, "s13")
    return spark.read.parquet(dead).select("entity", "seq", "reason")


STREAM_QUERIES = {
    "s01_account_stream": s01_account_stream,
    "s02_stateful_changes": s02_stateful_changes,
    "s04_product_stream": s04_product_stream,
    "s05_rate_stream": s05_rate_stream,
    "s05b_rates_before": s05b_rates_before,
    "s06_fact_stream": s06_fact_stream,
    "s07_account_messages": s07_account_messages,
    "s08_account_dead_letters": s08_account_dead_letters,
    "s09_rated_account_stream": s09_rated_account_stream,
    "s10_product_messages": s10_product_messages,
    "s11_rate_messages": s11_rate_messages,
    "s12_teller_messages": s12_teller_messages,
    "s13_rate_dead_letters": s13_rate_dead_letters,
}

#: A stream that has read all its input holds the rows of its batch twin.
STREAM_SQL = {
    "s01_account_stream": ORACLE_SQL["q09_account_scd2"],
    "s02_stateful_changes": ORACLE_SQL["q06_account_changes"],
    "s04_product_stream": ORACLE_SQL["q12_product_scd2"],
    "s05_rate_stream": ORACLE_SQL["q15_rates_final"],
    "s05b_rates_before": ORACLE_SQL["q14_rates_before"],
    "s06_fact_stream": ORACLE_SQL["q17_fact_rows"],
    "s07_account_messages": account_messages_sql(),
    "s09_rated_account_stream": ORACLE_SQL["q26_rated_account_scd2"],
    "s08_account_dead_letters": "SELECT event_id AS seq, 'missing:prtCode' AS reason FROM events WHERE event_id % 50 = 0",
}

#: The message loads: the batch twin over the events whose message has no fault.
_GOOD = fx.NO_FAULT_SQL.format("event_id")
STREAM_SQL |= {
    "s10_product_messages": ORACLE_SQL["q12_product_scd2"].replace(fx.FX_PRODUCT_SQL, fx.FX_PRODUCT_SQL[:-1] + f" WHERE {_GOOD})"),
    "s11_rate_messages": ORACLE_SQL["q15_rates_final"].replace(fx.FX_RATE_EVENTS_SQL, fx.FX_RATE_EVENTS_SQL[:-1] + f" AND {_GOOD})"),
    "s12_teller_messages": ORACLE_SQL["q17_fact_rows"].replace(
        "FROM orders),", f"FROM orders WHERE {fx.NO_FAULT_SQL.format('o_orderkey')}),"),
    "s13_rate_dead_letters": f"""SELECT CASE WHEN event_type = 'purchase' THEN 'overwrite' ELSE 'fill' END AS entity,
  event_id AS seq, CASE WHEN event_id % 50 = 0 THEN 'malformed' WHEN event_id % 49 = 0 THEN 'null'
    WHEN event_type = 'purchase' THEN 'unreadable:id' ELSE 'unreadable:accountNumber' END AS reason
FROM events WHERE event_type IN ('purchase', 'click') AND NOT ({_GOOD})""",
}
