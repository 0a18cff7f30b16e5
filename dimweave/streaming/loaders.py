"""Stream twins of the product, rate and fact loaders.

Each micro-batch reads only the store buckets its keys fall in, applies the batch
operator to those keys and writes the next version (see ``streaming.store``); the fact
stream is a stateless append with the file sink's exactly-once log.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimweave.operators.facts import teller_to_fact
from dimweave.operators.keys import assign_surrogate_keys
from dimweave.operators.ordered import chunk_rows_of
from dimweave.operators.rates import FILL, OVERWRITE, normalise_rate_events, rates_before, rates_final
from dimweave.operators.scd2 import IS_NEW, TOUCHED, scd2_versions
from dimweave.plans import fixtures as fx
from dimweave.plans import jobs
from dimweave.schemas import MONEY, PRODUCT_EVENT, RATE_FILL_EVENT, RATE_OVERWRITE_EVENT, TELLER_EVENT
from dimweave.session import ensure_checkpoint_dir
from dimweave.streaming.counts import counting, start_counted
from dimweave.streaming.decoded import Entity, run_messages
from dimweave.streaming.jobs import PLACE, place_before, rate_streams, semi, split_late, table_stream
from dimweave.streaming.store import VersionedStore
from dimweave.streaming.triggers import start

PRODUCT_DIM_COLUMNS = ["pd_dim_id", "product_no", *jobs.PRODUCT_ATTRS, "eff_seq", "end_seq", "eff_ts", "end_ts",
                       "loaded", "update_tms"]
FIRST_PRODUCT_KEY = 1
BEFORE_COLUMNS = ["seq", "account_no", "source", "rate", "rate_before"]


def _run(stream: DataFrame, handler, root: str, trigger: dict | None) -> None:
    start(stream.writeStream.foreachBatch(handler).option("checkpointLocation", posixpath.join(root, "checkpoint")),
          trigger)


# ------------------------------------------------------------------ products
def product_store(spark: SparkSession, sf_dir: str, root: str, buckets: int | None = None, retain: int | None = None) -> VersionedStore:
    """The product dimension's store under ``root``, made from the existing dimension at the first start."""
    store = VersionedStore(spark, posixpath.join(root, "store"), key="product_no", buckets=buckets, retain=retain)
    if store.latest() is None:
        seed = fx.fx_dim_product(spark, sf_dir).select(
            "*", F.lit(False).alias("loaded"), F.lit(None).cast("timestamp_ntz").alias("update_tms"))
        # Existing rows keep their (unknown here) warehouse keys; new ones get the sequence.
        seed = seed.withColumn("pd_dim_id", F.lit(None).cast("bigint"))
        rows = jobs.product_rows(fx.fx_product(spark, sf_dir))
        store.write(0, {"dim": seed.select(*PRODUCT_DIM_COLUMNS)}, empty={"last": rows.select("product_no", "seq").schema},
                    plain={"late": spark.createDataFrame([], rows.schema)})
    return store


def product_batch(store: VersionedStore, chunk_rows: int, metrics: list | None = None, late: str = "apply"):
    """The ``foreachBatch`` body of the product loads; ``late``: as in ``streaming.jobs.account_batch``."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = jobs.product_rows(batch).persist()
        touched_buckets = store.touched_buckets(batch.select("product_no"))
        dim, last = store.read(batch_id, "dim", touched_buckets), store.read(batch_id, "last", touched_buckets)
        touched = batch.select("product_no").distinct()
        dim_u, last_u = semi(dim, touched, "product_no", "left_anti"), semi(last, touched, "product_no", "left_anti")
        last_t = semi(last, touched, "product_no")
        on_time, aside = batch, batch.limit(0)
        if late == "divert":
            on_time, aside = split_late(batch, last_t.select("product_no", F.col("seq").alias("_dw_newest")), "product_no")
        new_last = (last_t.unionByName(on_time.select("product_no", "seq")).groupBy("product_no").agg(F.max("seq").alias("seq"))
                    .unionByName(last_u))
        first = batch.groupBy("product_no").agg(F.min("seq").alias("_dw_first"))
        dim_t = place_before(dim, first, "product_no", "eff_seq").withColumnRenamed(PLACE, f"eff_{PLACE}").withColumn(
            f"end_{PLACE}", F.col("end_seq"))
        ev = on_time.withColumns({"loaded": F.lit(True), "update_tms": F.lit(None).cast("timestamp_ntz"),
                                  "pd_dim_id": F.lit(None).cast("bigint"), PLACE: F.col("seq")})
        v = scd2_versions(ev, ["product_no"], [PLACE], jobs.PRODUCT_ATTRS,
                          [*jobs.PRODUCT_ATTRS, "loaded", "update_tms", "pd_dim_id"], bounds=[PLACE, *jobs.BOUNDS], seed=dim_t,
                          compare_with_seed=True, close="standard", chunk_rows=chunk_rows)
        v = v.withColumn("update_tms", F.when(F.col(TOUCHED), F.col("end_ts")).otherwise(F.col("update_tms")))
        # The batch's versions feed two branches (new rows get keys, existing rows keep
        # theirs): materialise them once in the shared checkpoint folder.
        ensure_checkpoint_dir(store.spark)
        v = v.checkpoint(eager=True)
        # Surrogate keys continue the sequence kept with the store version, so a retried
        # batch hands out the same keys.
        start = store.value(batch_id, "next_pd_dim_id", FIRST_PRODUCT_KEY)
        new = v.filter(F.col(IS_NEW)).drop("pd_dim_id")
        keyed = assign_surrogate_keys(new, "product_no", ["eff_seq"], out="pd_dim_id", start=start,
                                      chunk_rows=chunk_rows, materialize=False)
        n_new = keyed.count()
        new_dim = (keyed.select(*PRODUCT_DIM_COLUMNS)
                   .unionByName(v.filter(~F.col(IS_NEW)).select(*PRODUCT_DIM_COLUMNS))
                   .unionByName(dim_u.select(*PRODUCT_DIM_COLUMNS)))
        obs = Observation(f"product_late_{batch_id}")
        aside = aside.observe(obs, F.count(F.lit(1)).alias("late_rows"))
        store.write(batch_id + 1, {"dim": new_dim, "last": new_last}, touched=touched_buckets, plain={"late": aside},
                    base=batch_id, values={"next_pd_dim_id": start + n_new})
        batch.unpersist()
        if metrics is not None:
            metrics.append({"batch": batch_id, "new_versions": n_new, **obs.get})

    return apply


def run_product_stream(spark: SparkSession, sf_dir: str, root: str, *, source_dir: str | None = None,
                       glob: str | None = None, max_files_per_trigger: int = 1, metrics: list | None = None,
                       buckets: int | None = None, events: DataFrame | None = None, late: str = "apply",
                       retain: int | None = None, trigger: dict | None = None) -> VersionedStore:
    """``events``: any streaming product events instead of the given table; ``late``: as in
    ``streaming.jobs.account_batch``."""
    store = product_store(spark, sf_dir, root, buckets, retain)
    if events is None:
        events = fx.product_events_from(table_stream(spark, sf_dir, "events", source_dir=source_dir, glob=glob,
                                                     max_files_per_trigger=max_files_per_trigger))
    _run(events, product_batch(store, chunk_rows_of(spark), metrics, late), root, trigger)
    return store


def run_product_messages(spark: SparkSession, messages: DataFrame, sf_dir: str, root: str, *, metrics: list | None = None,
                         buckets: int | None = None, late: str = "apply", retain: int | None = None,
                         trigger: dict | None = None) -> tuple[VersionedStore, str]:
    """The product load from message text; the store and the dead letters' folder (see ``streaming.decoded``)."""
    store = product_store(spark, sf_dir, root, buckets, retain)
    product = Entity("product", PRODUCT_EVENT, jobs.product_events_from_messages, ["productNo"])
    return store, run_messages([(product, messages)], product_batch(store, chunk_rows_of(spark), metrics, late), root, trigger=trigger)


def product_stream_layout(dim: DataFrame) -> DataFrame:
    return dim.select("product_no", *jobs.PRODUCT_ATTRS, "eff_seq", "end_seq", F.col("eff_ts").alias("eff_dt"),
                      F.col("end_ts").alias("end_dt"), "update_tms", F.col("loaded").alias(IS_NEW))


# ------------------------------------------------------------------ rates
def rate_store(spark: SparkSession, sf_dir: str, root: str, buckets: int | None = None, retain: int | None = None) -> VersionedStore:
    """The rates' store under ``root``, made from the existing rates at the first start."""
    store = VersionedStore(spark, posixpath.join(root, "store"), key="account_no", buckets=buckets, retain=retain)
    if store.latest() is None:
        dim = fx.fx_rate_dim(spark, sf_dir).select("account_no", F.col("rate").cast(MONEY).alias("rate"))
        empty = spark.createDataFrame([], "seq bigint, account_no bigint, source string, rate decimal(38,10), "
                                          "rate_before decimal(38,10)")
        store.write(0, {"rates": dim}, plain={"before": empty})
    return store


def rate_batch(store: VersionedStore, chunk_rows: int, metrics: list | None = None):
    """The ``foreachBatch`` body of the rate loads: each batch emits every known account's rate
    before each event and writes the rates after it.  ``metrics`` receives per batch the number of
    events and of events for accounts the dimension does not know (they change nothing and are
    otherwise lost)."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        touched_buckets = store.touched_buckets(batch.select("account_no"))
        dim = store.read(batch_id, "rates", touched_buckets)
        touched = batch.select("account_no").distinct()
        dim_t, dim_u = semi(dim, touched, "account_no"), semi(dim, touched, "account_no", "left_anti")
        before = rates_before(batch, dim_t, key="account_no", order=["seq"], dim_key="account_no",
                              dim_rate="rate", chunk_rows=chunk_rows).select(*BEFORE_COLUMNS)
        final = rates_final(batch, dim_t, key="account_no", order=["seq"], dim_key="account_no", dim_rate="rate")
        store.write(batch_id + 1, {"rates": final.unionByName(dim_u)}, touched=touched_buckets,
                    plain={"before": before}, base=batch_id)
        if metrics is not None:
            known = dim_t.select("account_no", F.lit(True).alias("_dw_known"))
            m = batch.join(known, "account_no", "left").agg(
                F.count(F.lit(1)).alias("events"),
                F.coalesce(F.sum(F.col("_dw_known").isNull().cast("int")), F.lit(0)).alias("unknown_account_events"),
            ).first()
            metrics.append({"batch": batch_id, **m.asDict()})
        batch.unpersist()

    return apply


def run_rate_stream(spark: SparkSession, sf_dir: str, root: str, *, source_dir: str | None = None,
                    glob: str | None = None, max_files_per_trigger: int = 1,
                    buckets: int | None = None, metrics: list | None = None, events: DataFrame | None = None,
                    retain: int | None = None, trigger: dict | None = None) -> VersionedStore:
    """Two rate sources (overwrite and fill), unioned into one stream (see ``rate_batch``).
    ``events``: any streaming rate events (account_no, seq, rate, source) instead of the given table."""
    store = rate_store(spark, sf_dir, root, buckets, retain)
    if events is None:
        events = rate_streams(lambda: table_stream(spark, sf_dir, "events", source_dir=source_dir, glob=glob,
                                                   max_files_per_trigger=max_files_per_trigger))
    _run(events, rate_batch(store, chunk_rows_of(spark), metrics), root, trigger)
    return store


def run_rate_messages(spark: SparkSession, overwrite: DataFrame, fill: DataFrame, sf_dir: str, root: str, *,
                      metrics: list | None = None, buckets: int | None = None, retain: int | None = None,
                      trigger: dict | None = None) -> tuple[VersionedStore, str]:
    """Both rate sources from message text, as one query; the store and the dead letters' folder
    (see ``streaming.decoded``).  ``seq`` must tell an account's events of both sources apart."""
    store = rate_store(spark, sf_dir, root, buckets, retain)
    ow = Entity(OVERWRITE, RATE_OVERWRITE_EVENT, lambda g: normalise_rate_events(
        g, key="id", rate="interestNumber", source=OVERWRITE, order=["seq"]), ["id"], {"id": "bigint"})
    fl = Entity(FILL, RATE_FILL_EVENT, lambda g: normalise_rate_events(
        g, key="accountNumber", rate="crIntRate", source=FILL, order=["seq"]), ["accountNumber"], {"accountNumber": "bigint"})
    return store, run_messages([(ow, overwrite), (fl, fill)], rate_batch(store, chunk_rows_of(spark), metrics), root, trigger=trigger)


def rate_stream_before(store: VersionedStore) -> DataFrame:
    """Every batch's emitted rows (a loop over versions, not over rows)."""
    parts = [store.read(v, "before") for v in store.versions()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ facts
def run_fact_stream(spark: SparkSession, sf_dir: str, root: str, *, source_dir: str | None = None,
                    glob: str | None = None, max_files_per_trigger: int = 1, tellers: DataFrame | None = None,
                    metrics: list | None = None, trigger: dict | None = None) -> str:
    """Teller rows -> fact rows, appended with the file sink's exactly-once log.  ``tellers``:
    any streaming teller rows instead of the given table.  ``metrics`` receives each batch's
    number of fact rows."""
    if tellers is None:
        tellers = fx.teller_from(table_stream(spark, sf_dir, "orders", source_dir=source_dir, glob=glob,
                                              max_files_per_trigger=max_files_per_trigger))
    facts = teller_to_fact(tellers, fx.fx_customer_dim(spark, sf_dir), dim_key="c_custkey",
                           dim_id="cst_dim_id", load_date=fx.FACT_LOAD_DATE)
    out = posixpath.join(root, "facts")
    facts, name = counting(facts)
    writer = (facts.writeStream.format("parquet").option("path", out)
              .option("checkpointLocation", posixpath.join(root, "checkpoint")).outputMode("append"))
    if metrics is None:
        start(writer, trigger)
    else:
        start_counted(spark, writer, name, metrics, trigger)
    return out


def run_fact_messages(spark: SparkSession, messages: DataFrame, sf_dir: str, root: str, *, metrics: list | None = None,
                      trigger: dict | None = None) -> tuple[str, str]:
    """The fact load from message text; the folders of the facts and of the dead letters (see
    ``streaming.decoded``).  Each batch writes its facts under its id (column ``batch``), so a batch
    that is run again writes the same files."""
    out = posixpath.join(root, "facts")
    customers = fx.fx_customer_dim(spark, sf_dir)

    def load(tellers: DataFrame, batch_id: int) -> None:
        obs = Observation(f"facts_{batch_id}")
        facts = teller_to_fact(tellers, customers, dim_key="c_custkey", dim_id="cst_dim_id", load_date=fx.FACT_LOAD_DATE)
        facts = facts.observe(obs, F.count(F.lit(1)).alias("rows"))
        facts.write.mode("overwrite").parquet(posixpath.join(out, f"batch={batch_id}"))
        if metrics is not None:
            metrics.append({"batch": batch_id, **obs.get})

    teller = Entity("teller", TELLER_EVENT, lambda g: g, ["id"])
    return out, run_messages([(teller, messages)], load, root, trigger=trigger)
