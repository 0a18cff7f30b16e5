"""Surrogate keys (a sequence's NEXTVAL) without a global sort in one task and without any
window over the rows.

Numbering order is (bucket, key, order); the bucket is pmod(key, buckets) for whole numbers
and a hash for other types, and a null key is a key like any other (bucket 0, sorted first).
The rows are dealt into ranges of that whole tuple, sorted inside them and checkpointed, so a
row's place in its partition is fixed and read off the partition's row counter; the rows of the
partitions before it are a running total over one count for each partition.  A hot key is cut by
its order columns like everything else.  Keys come out dense and unique, starting at ``start``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.operators.ordered import DEFAULT_CHUNK_ROWS, MAX_BROADCAST_CHUNKS
from dimweave.session import ensure_checkpoint_dir

# monotonically_increasing_id holds the partition above its lower 33 bits, the row's place in them.
PLACE_BITS = 33


def _bucket(df: DataFrame, key: str, buckets: int) -> Column:
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    number = F.col(key).cast("long") if whole else F.xxhash64(key)
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.pmod(number, F.lit(buckets)).cast("int"))


def assign_surrogate_keys(df: DataFrame, key: str, order: Sequence[str], *, out: str, start: int = 1,
                          buckets: int = 64, chunk_rows: int = DEFAULT_CHUNK_ROWS,
                          materialize: bool = True) -> DataFrame:
    """``chunk_rows``: rows of a range partition.  ``materialize``: the rows are read three times
    (count, range sample, exchange); checkpoint them once to the shared folder rather than
    recompute the plan that made them."""
    ensure_checkpoint_dir(df.sparkSession)
    if materialize:
        df = df.checkpoint(eager=True)
    cols = df.columns
    parts = max(1, -(-df.count() // chunk_rows))
    by = ["_dw_bucket", key, *order]
    x = (df.withColumn("_dw_bucket", _bucket(df, key, buckets)).repartitionByRange(parts, *by).sortWithinPartitions(*by)
         .select(*cols).checkpoint(eager=True))
    x = x.withColumn("_dw_at", F.monotonically_increasing_id())
    part = F.shiftright("_dw_at", PLACE_BITS).alias("_dw_part")
    # One row for each partition: rows / chunk_rows of them.
    counts = x.groupBy(part).agg(F.count(F.lit(1)).alias("_dw_n"))
    before = Window.orderBy("_dw_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_dw_part", F.coalesce(F.sum("_dw_n").over(before), F.lit(0)).alias("_dw_off"))
    if parts <= MAX_BROADCAST_CHUNKS:
        offsets = F.broadcast(offsets)
    res = x.withColumn("_dw_part", part).join(offsets, "_dw_part")
    place = F.col("_dw_at").bitwiseAND(F.lit(2 ** PLACE_BITS - 1))
    return res.select((F.lit(start).cast("long") + F.col("_dw_off") + place).alias(out), *cols)
