"""Rate updates from two sources on a dimension's rate column.

* overwrite source: sets the rate whenever the event carries one;
* fill source: sets the rate only while the dimension's rate is null.

Read together, in event order per account, the rate after any prefix of events is
``coalesce(latest non-null overwrite, rate before the load, earliest non-null fill)``:
an overwrite wins for good, and a fill only lands while nothing else is there.  So the
rate seen *before* each event is the same expression over the earlier events (a keyed
scan), and the final rate is one hash aggregation per account with a map-side partial
step, which combines a hot account before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dimweave.operators.ordered import DEFAULT_CHUNK_ROWS, drop_scan_columns, keyed_scan, left_join_null_safe
from dimweave.schemas import MONEY

OVERWRITE = "overwrite"
FILL = "fill"


def normalise_rate_events(df: DataFrame, *, key: str, rate: str, source: str, order: Sequence[str],
                          out_key: str = "account_no") -> DataFrame:
    """Either source's events -> (key, order..., rate decimal(38,10), source)."""
    return df.select(F.col(key).alias(out_key), *order, F.col(rate).cast(MONEY).alias("rate"),
                     F.lit(source).alias("source"))


def rate_events(overwrite: DataFrame, fill: DataFrame) -> DataFrame:
    """Bag union of the two normalised streams (same schema, by name)."""
    return overwrite.unionByName(fill)


def _dim_rates(dim: DataFrame, dim_key: str, dim_rate: str, key: str) -> DataFrame:  # used by rates_final
    return dim.select(F.col(dim_key).alias(key), F.col(dim_rate).cast(MONEY).alias("_dw_dim_rate"))


def rates_before(events: DataFrame, dim: DataFrame, *, key: str, order: Sequence[str], dim_key: str,
                 dim_rate: str, out: str = "rate_before", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """For every event of an account present in ``dim`` (one row per account), the
    account's rate just before the event; events of unknown accounts are dropped.

    The dimension's row joins the scan as the account's row 0 (a null order sorts
    first), so the events are shuffled once, with no join before the scan."""
    order = list(order)
    types = {f.name: f.dataType for f in events.schema.fields}
    extra = [c for c in events.columns if c not in {key, *order, "rate", "source"}]
    ev = events.select(key, *order, *extra, F.col("rate").cast(MONEY).alias("rate"), "source",
                       F.lit(None).cast(MONEY).alias("_dw_dim_rate"), F.lit(False).alias("_dw_is_dim"))
    d = dim.select(F.col(dim_key).cast(types[key]).alias(key),
                   *[F.lit(None).cast(types[c]).alias(c) for c in [*order, *extra]],
                   F.lit(None).cast(MONEY).alias("rate"), F.lit(None).cast("string").alias("source"),
                   F.col(dim_rate).cast(MONEY).alias("_dw_dim_rate"), F.lit(True).alias("_dw_is_dim"))
    ow = F.when((F.col("source") == OVERWRITE) & F.col("rate").isNotNull(), F.col("rate"))
    fl = F.when((F.col("source") == FILL) & F.col("rate").isNotNull(), F.col("rate"))
    known = F.when(F.col("_dw_is_dim"), F.struct(F.col("_dw_dim_rate").alias("v")))
    x = keyed_scan(ev.unionByName(d), [key], order, last_before={"_dw_ow": ow},
                   first_before={"_dw_fill": fl, "_dw_known": known}, chunk_rows=chunk_rows)
    x = drop_scan_columns(x).filter(~F.col("_dw_is_dim") & F.col("_dw_known").isNotNull())
    rate = F.coalesce(F.col("_dw_ow"), F.col("_dw_known.v"), F.col("_dw_fill"))
    return x.select(key, *order, *extra, "rate", "source", rate.alias(out))


def rates_final(events: DataFrame, dim: DataFrame, *, key: str, order: Sequence[str], dim_key: str,
                dim_rate: str, out: str = "rate") -> DataFrame:
    """Every dimension row with its rate after all events."""
    o = F.struct(*order)
    has = F.col("rate").isNotNull()
    agg = events.groupBy(key).agg(
        F.max_by(F.col("rate"), F.when((F.col("source") == OVERWRITE) & has, o)).alias("_dw_ow"),
        F.min_by(F.col("rate"), F.when((F.col("source") == FILL) & has, o)).alias("_dw_fill"),
    )
    d = _dim_rates(dim, dim_key, dim_rate, key)
    return (left_join_null_safe(d, agg, [key], broadcast=False)
            .select(key, F.coalesce(F.col("_dw_ow"), F.col("_dw_dim_rate"), F.col("_dw_fill")).alias(out)))


def rates_by_version(versions: DataFrame, events: DataFrame, *, key: str, order: Sequence[str], dim_key: str,
                     tell_apart: Sequence[str] = (), rate: str = "rate", chunk_rows: int = DEFAULT_CHUNK_ROWS,
                     observe: Observation | None = None) -> DataFrame:
    """A versioned dimension (``eff_``/``end_`` columns for every order column) after rate
    events: each event acts on the version of its account that is in force at its place in the
    order (a version that begins there is), and on no other.

    ``tell_apart``: further ``eff_`` columns by which versions that begin at one place are ordered;
    the last takes the event.  Events of unknown accounts, and those that come while no version is
    in force, change nothing; ``observe`` counts them (``unmatched_rates``) and all
    (``rate_events``).  Versions and events meet in one keyed scan, so there is no range join and
    a hot account is cut into chunks.  Its events are then combined map-side for each version."""
    order, own = list(order), [*[f"eff_{o}" for o in order], *tell_apart]
    ends = [f"end_{o}" for o in order]
    begun = F.struct(*[F.col(c).alias(f"_dw_e{i}") for i, c in enumerate(own)])
    v = versions.select(F.col(dim_key).alias(key), *[F.col(f"eff_{o}").alias(o) for o in order],
                        F.lit(False).alias("_dw_event"), begun.alias("_dw_begun"), F.struct(*ends).alias("_dw_end"))
    ev = events.select(F.col(key).cast(v.schema[key].dataType).alias(key), *order, F.lit(True).alias("_dw_event"),
                       F.col("rate").cast(MONEY).alias("_dw_rate"), "source")
    here = F.when(~F.col("_dw_event"), F.struct("_dw_begun", "_dw_end"))
    x = keyed_scan(v.unionByName(ev, allowMissingColumns=True), [key], [*order, "_dw_event", "_dw_begun", "source"],
                   last_before={"_dw_in": here}, chunk_rows=chunk_rows)
    in_force = F.col("_dw_in").isNotNull() & (F.col(f"_dw_in._dw_end.{ends[0]}").isNull() | (F.struct(*order) < F.struct(
        *[F.col(f"_dw_in._dw_end.{c}").alias(o) for c, o in zip(ends, order)])))
    x = drop_scan_columns(x).withColumn("_dw_hit", F.col("_dw_event") & in_force)
    if observe is not None:
        unmatched = F.col("_dw_event") & ~F.col("_dw_hit")
        x = x.observe(observe, F.count_if(F.col("_dw_event")).alias("rate_events"), F.count_if(unmatched).alias("unmatched_rates"))
    o, has = F.struct(*order), F.col("_dw_rate").isNotNull()
    agg = x.filter("_dw_hit").groupBy(key, "_dw_in._dw_begun").agg(
        F.max_by("_dw_rate", F.when((F.col("source") == OVERWRITE) & has, o)).alias("_dw_ow"),
        F.min_by("_dw_rate", F.when((F.col("source") == FILL) & has, o)).alias("_dw_fill"))
    agg = agg.select(F.col(key).alias(dim_key), *[F.col(f"_dw_begun._dw_e{i}").alias(c) for i, c in enumerate(own)],
                     "_dw_ow", "_dw_fill")
    joined = left_join_null_safe(versions, agg, [dim_key, *own], broadcast=False)
    after = F.coalesce(F.col("_dw_ow"), F.col(rate).cast(MONEY), F.col("_dw_fill"))
    return joined.withColumn(rate, after).select(*versions.columns)
