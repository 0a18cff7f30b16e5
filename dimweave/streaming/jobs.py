"""Streaming loaders: the account dimension on Structured Streaming.

* ``run_account_stream``: file/topic source -> account events -> ``foreachBatch``; each
  micro-batch applies the batch operators to the keys it touches and writes the next
  store version (dimension + last event per key).  Same rows as one batch over all
  events, for in-order arrival.
* ``stateful_changes``: change detection with keyed state (``applyInPandasWithState``),
  the stream twin of ``changed_rows``.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from dimweave.operators.ordered import chunk_rows_of
from dimweave.operators.rates import FILL, OVERWRITE, normalise_rate_events, rate_events, rates_by_version
from dimweave.operators.scd2 import TOUCHED
from dimweave.plans import fixtures as fx
from dimweave.plans import jobs
from dimweave.schemas import ACCOUNT_EVENT, MONEY
from dimweave.session import ensure_checkpoint_dir
from dimweave.sources.streams import open_files
from dimweave.streaming.decoded import Entity, run_messages
from dimweave.streaming.store import VersionedStore
from dimweave.streaming.triggers import start

DIM_COLUMNS = ["id", *jobs.ACCOUNT_COLUMNS, "eff_seq", "end_seq", "eff_ts", "end_ts", "loaded", "update_tms"]
RATE_COLUMNS = ["rate", "source"]
LAST_COLUMNS = ["id", "seq", "ts", *jobs.ACCOUNT_COMPARE]
#: The order that a batch is applied in: what is there already comes before every row of the
#: batch, the batch's rows go by ``seq``.
PLACE = "_dw_place"


def table_stream(spark: SparkSession, sf_dir: str, table: str, *, source_dir: str | None = None, glob: str | None = None,
                 max_files_per_trigger: int = 1) -> DataFrame:
    """A given table as a stream: ``<sf_dir>/<table>.parquet``, a file or a folder of part
    files, or the files of another folder."""
    path = posixpath.join(sf_dir, f"{table}.parquet")
    # The source wants a folder, or a pattern, which may as well name one file.
    pattern = posixpath.join(sf_dir, f"[{table[0]}]{table[1:]}.parquet")
    return open_files(spark, source_dir or pattern, spark.read.parquet(path).schema,
                      max_files_per_trigger=max_files_per_trigger, glob=glob)


def semi(df: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose key is (or with ``left_anti`` isn't) among ``keys``; a null key is a key."""
    k = keys.select(F.col(key).alias("_dw_touched_key"))
    return df.join(k, df[key].eqNullSafe(k["_dw_touched_key"]), how)


def place_before(df: DataFrame, first: DataFrame, key: str, seq: str) -> DataFrame:
    """``df`` with its place: its own order, or just before the batch's first row of its key
    (``first``: key, _dw_first) where that is earlier."""
    f = first.select(F.col(key).alias("_dw_first_key"), "_dw_first")
    x = df.join(f, df[key].eqNullSafe(f["_dw_first_key"]))
    return x.withColumn(PLACE, F.least(F.col(seq), F.col("_dw_first") - 1)).drop("_dw_first_key", "_dw_first")


def split_late(batch: DataFrame, newest: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(on time, late): late rows aren't after the last event applied for their key (``newest``:
    key, _dw_newest)."""
    n = newest.select(F.col(key).alias("_dw_newest_key"), "_dw_newest")
    tagged = batch.join(n, batch[key].eqNullSafe(n["_dw_newest_key"]), "left").drop("_dw_newest_key")
    is_late = F.col("_dw_newest").isNotNull() & (F.col("seq") <= F.col("_dw_newest"))
    return tagged.filter(~is_late).drop("_dw_newest"), tagged.filter(is_late).drop("_dw_newest")


def seed_store(store: VersionedStore, seed: DataFrame, account_events: DataFrame) -> None:
    """Version 0: the existing dimension and an empty last-event table."""
    dim = seed.select(*[c for c in seed.columns], F.lit(False).alias("loaded"),
                      F.lit(None).cast("timestamp_ntz").alias("update_tms")).select(*DIM_COLUMNS)
    spark = seed.sparkSession
    late = spark.createDataFrame([], account_events.select(*LAST_COLUMNS).schema)
    store.write(0, {"dim": dim}, empty={"last": account_events.select(*LAST_COLUMNS).schema}, plain={"late": late})


def account_batch(store: VersionedStore, az: DataFrame, accr: DataFrame, chunk_rows: int,
                  metrics: list | None = None, late: str = "apply", rated: bool = False):
    """The ``foreachBatch`` body: version ``b`` + batch ``b`` -> version ``b + 1``.

    ``rated``: the batch holds rate events too (``source`` and ``rate``; account events have
    neither).  The account events open and close versions first, then each rate event acts on the
    version in force at its place, so one commit holds both.

    ``late``: events that are older than the last one applied for their key are applied in the
    order in which they arrive (``apply``), or set aside in the version's ``late`` table, which
    ``late_rows`` reads, and counted in ``metrics`` (``divert``)."""
    if late not in ("apply", "divert"):
        raise ValueError(f"unknown late rule {late!r}")

    def apply(batch: DataFrame, batch_id: int) -> None:
        # The batch is read several times below; keep it for the duration of the batch.
        batch = batch.select(*LAST_COLUMNS, *(RATE_COLUMNS if rated else [])).persist()
        # Only the buckets holding this batch's keys are read and rewritten.
        buckets = store.touched_buckets(batch.select("id"))
        dim, last = store.read(batch_id, "dim", buckets), store.read(batch_id, "last", buckets)
        touched = batch.select("id").distinct()
        dim_u, last_u = semi(dim, touched, "id", "left_anti"), semi(last, touched, "id", "left_anti")
        last_t = semi(last, touched, "id")
        own = (batch.filter(F.col("source").isNull()) if rated else batch).select(*LAST_COLUMNS)
        on_time, aside = own, own.limit(0)
        if late == "divert":
            on_time, aside = split_late(own, last_t.select("id", F.col("seq").alias("_dw_newest")), "id")
        first = batch.groupBy("id").agg(F.min("seq").alias("_dw_first"))
        prior = place_before(last_t, first, "id", "seq")
        dim_t = place_before(dim, first, "id", "eff_seq").withColumnRenamed(PLACE, f"eff_{PLACE}").withColumn(
            f"end_{PLACE}", F.col("end_seq"))
        ev = on_time.withColumns({"loaded": F.lit(True), "update_tms": F.lit(None).cast("timestamp_ntz"), PLACE: F.col("seq")})
        v = jobs.account_versions(ev, dim_t, az, accr, prior=prior, chunk_rows=chunk_rows, order=[PLACE],
                                  bounds=[PLACE, *jobs.BOUNDS], extra_columns=("loaded", "update_tms"))
        matched = Observation(f"rates_{batch_id}") if rated else None
        if rated:
            ensure_checkpoint_dir(batch.sparkSession)
            v = v.checkpoint()  # read by the scan and by the join
            ra = batch.filter(F.col("source").isNotNull()).select("id", F.col("seq").alias(PLACE), *RATE_COLUMNS)
            v = rates_by_version(v, ra, key="id", order=[PLACE], dim_key="id", tell_apart=["eff_seq"],
                                 chunk_rows=chunk_rows, observe=matched)
        new_t = v.withColumn("update_tms", F.when(F.col(TOUCHED), F.col("end_ts")).otherwise(F.col("update_tms")))
        new_dim = new_t.select(*DIM_COLUMNS).unionByName(dim_u.select(*DIM_COLUMNS))
        last_rows = (last_t.select(*LAST_COLUMNS, F.lit(0).alias("_dw_new"))
                     .unionByName(on_time.select(*LAST_COLUMNS, F.lit(1).alias("_dw_new"))))
        new_last = (last_rows.groupBy("id").agg(F.max_by(F.struct(*LAST_COLUMNS[1:]), F.struct("_dw_new", "seq")).alias("r"))
                    .select("id", "r.*").unionByName(last_u.select(*LAST_COLUMNS)))
        obs, seen = Observation(f"load_{batch_id}"), Observation(f"late_{batch_id}")
        new_dim = new_dim.observe(obs, F.count(F.lit(1)).alias("rows"),
                                  F.sum(F.col("loaded").cast("int")).alias("loaded_rows"))
        aside = aside.observe(seen, F.count(F.lit(1)).alias("late_rows"))
        store.write(batch_id + 1, {"dim": new_dim, "last": new_last}, touched=buckets, plain={"late": aside},
                    base=batch_id)
        batch.unpersist()
        if metrics is not None:
            metrics.append({"batch": batch_id, **obs.get, **seen.get, **(matched.get if matched else {})})

    return apply


def late_rows(store: VersionedStore) -> DataFrame:
    """Every row that any batch set aside, with its version."""
    parts = [store.read(v, "late").withColumn("version", F.lit(v)) for v in store.versions()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_account_stream(spark: SparkSession, sf_dir: str, root: str, *, source_dir: str | None = None,
                       glob: str | None = None, max_files_per_trigger: int = 1,
                       metrics: list | None = None, buckets: int | None = None, events: DataFrame | None = None,
                       late: str = "apply", retain: int | None = None, trigger: dict | None = None) -> VersionedStore:
    """Run the account stream (see ``streaming.triggers`` for ``trigger``, ``streaming.store`` for ``retain``).  ``events``: any
    streaming account events (id, seq, ts and the compared fields) instead of the given table."""
    store = VersionedStore(spark, posixpath.join(root, "store"), key="id", buckets=buckets, retain=retain)
    if store.latest() is None:
        seed_store(store, fx.fx_dim_account(spark, sf_dir), fx.fx_account(spark, sf_dir))
    if events is None:
        events = fx.account_events_from(table_stream(spark, sf_dir, "events", source_dir=source_dir, glob=glob,
                                                     max_files_per_trigger=max_files_per_trigger))
    handler = account_batch(store, fx.fx_az(spark, sf_dir), fx.fx_accr(spark, sf_dir), chunk_rows_of(spark),
                            metrics, late)
    start(events.writeStream.foreachBatch(handler).option("checkpointLocation", posixpath.join(root, "checkpoint")),
          trigger)
    return store


def rate_streams(source: Callable[[], DataFrame]) -> DataFrame:
    """Both rate sources of an events stream, normalised and unioned; each reads a ``source()`` of
    its own."""
    return rate_events(*[normalise_rate_events(fx.rate_source_from(source(), kind), key="account", rate="amount", source=name,
                                               order=["seq"]) for kind, name in (("purchase", OVERWRITE), ("click", FILL))])


def run_rated_account_stream(spark: SparkSession, sf_dir: str, root: str, *, source_dir: str | None = None,
                             glob: str | None = None, max_files_per_trigger: int = 1, metrics: list | None = None,
                             buckets: int | None = None, events: DataFrame | None = None, rates: DataFrame | None = None,
                             late: str = "apply", trigger: dict | None = None) -> VersionedStore:
    """Account events and both rate sources on one account dimension: the three streams are one
    query with one checkpoint, so a micro-batch commits what all of them brought, and a later
    account batch closes the version with the rate that it got.  ``events`` and ``rates``
    (account_no, seq, rate, source): any streaming frames instead of the given table."""
    store = VersionedStore(spark, posixpath.join(root, "store"), key="id", buckets=buckets)
    if store.latest() is None:
        seed_store(store, fx.fx_dim_account(spark, sf_dir), fx.fx_account(spark, sf_dir))

    def source() -> DataFrame:
        return table_stream(spark, sf_dir, "events", source_dir=source_dir, glob=glob, max_files_per_trigger=max_files_per_trigger)

    if events is None:
        events = fx.account_events_from(source())
    if rates is None:
        rates = rate_streams(source)
    events = events.select(*LAST_COLUMNS, F.lit(None).cast(MONEY).alias("rate"), F.lit(None).cast("string").alias("source"))
    both = events.unionByName(rates.select(F.col("account_no").cast(events.schema["id"].dataType).alias("id"), "seq", *RATE_COLUMNS),
                              allowMissingColumns=True)
    handler = account_batch(store, fx.fx_az(spark, sf_dir), fx.fx_accr(spark, sf_dir), chunk_rows_of(spark), metrics, late, rated=True)
    start(both.writeStream.foreachBatch(handler).option("checkpointLocation", posixpath.join(root, "checkpoint")), trigger)
    return store


def run_account_messages(spark: SparkSession, messages: DataFrame, sf_dir: str, root: str, *,
                         required: Sequence[str] = ("id", "prtCode", "opType"), metrics: list | None = None,
                         buckets: int | None = None, late: str = "apply",
                         trigger: dict | None = None) -> tuple[VersionedStore, str]:
    """The account load from a stream of messages (``value`` text, ``seq``, ``ts``; for example
    ``open_topic`` with its offset and timestamp under these names): decoded by the entity's
    schema, dead letters appended to a folder of their own, the rest loaded.  Returns the store
    and the dead letters' folder (see ``streaming.decoded``)."""
    store = VersionedStore(spark, posixpath.join(root, "store"), key="id", buckets=buckets)
    if store.latest() is None:
        seed_store(store, fx.fx_dim_account(spark, sf_dir), fx.fx_account(spark, sf_dir))
    load = account_batch(store, fx.fx_az(spark, sf_dir), fx.fx_accr(spark, sf_dir), chunk_rows_of(spark), metrics, late)
    account = Entity("account", ACCOUNT_EVENT, jobs.account_events_from_messages, required, {"id": "bigint"})
    folder = run_messages([(account, messages)], load, root, trigger=trigger)
    return store, folder


def account_stream_layout(dim: DataFrame) -> DataFrame:
    return jobs.account_dimension_layout(dim, F.col("update_tms"), "loaded")


# ------------------------------------------------------------------ keyed state (STA-1)
JSON = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def stateful_changes(stream: DataFrame, key: str, order: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Rows that differ from the key's last row, with the last row kept in keyed state.

    Spark does not order a group's rows inside a micro-batch, so the handler sorts
    them.  Compared values and whole rows pass through Python as JSON text, so that whole
    numbers of any size and nulls stay what they are; Python only compares texts.
    """
    rows = stream.select(F.col(key), *[F.col(o).alias(f"_dw_o{i}") for i, o in enumerate(order)],
                         F.to_json(F.struct(*compare), JSON).alias("_dw_cmp"),
                         F.to_json(F.struct(*stream.columns), JSON).alias("_dw_row"))
    by = [f"_dw_o{i}" for i in range(len(order))]

    def handle(key_value, frames, state):
        pdf = pd.concat(list(frames), ignore_index=True).sort_values(by, kind="stable").reset_index(drop=True)
        before = [state.get[0] if state.exists else None, *pdf["_dw_cmp"].iloc[:-1]]
        state.update((pdf["_dw_cmp"].iloc[-1],))
        changed = [b is None or b != c for b, c in zip(before, pdf["_dw_cmp"])]
        yield pdf.loc[changed, ["_dw_row"]]

    out = rows.groupBy(key).applyInPandasWithState(
        handle, "_dw_row string", "_dw_cmp string", "append", GroupStateTimeout.NoTimeout)
    return out.select(F.from_json("_dw_row", stream.schema, JSON).alias("r")).select("r.*")


def run_stateful_changes(spark: SparkSession, sf_dir: str, root: str, *, source_dir: str | None = None,
                         glob: str | None = None, max_files_per_trigger: int = 1,
                         trigger: dict | None = None) -> str:
    src = table_stream(spark, sf_dir, "events", source_dir=source_dir, glob=glob, max_files_per_trigger=max_files_per_trigger)
    acc = fx.account_events_from(src).select(*LAST_COLUMNS)
    out = posixpath.join(root, "changes")
    start(stateful_changes(acc, "id", jobs.ORDER, jobs.ACCOUNT_COMPARE).writeStream.format("parquet")
          .option("path", out).option("checkpointLocation", posixpath.join(root, "checkpoint"))
          .outputMode("append"), trigger)
    return out
