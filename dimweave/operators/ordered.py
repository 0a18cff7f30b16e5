"""Per-key ordered scans (lag / lead / running first-last non-null) that survive hot keys.

A plain ``Window.partitionBy(key).orderBy(seq)`` sends every row of a key to one task;
if one key holds a third of the data, that task holds a third of the data.  Here a key
with more than ``chunk_rows`` rows is cut into order-respecting chunks of about
``chunk_rows`` rows; the window runs per (key, chunk), and a small carry table (one
row per chunk of a hot key) supplies what a chunk needs from the chunks before or
after it.

Cost: one partial aggregation (row count per key, over a hash-chosen sample of the rows); for
hot keys, splitters at equal ranks of a thinner sample, over the whole order tuple and whatever
its types, at most ``rows / chunk_rows`` of them and therefore safe to broadcast; one shuffle
of the rows by (key, chunk); a carry table built by a partial aggregation over the rows of hot keys only (one row per hot chunk,
again at most ``rows / chunk_rows`` rows, broadcast).  A later scan over a subset of the
rows can reuse the same chunks (``chunked=True``) and so needs no further shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.session import ensure_checkpoint_dir

CHUNK = "_dw_chunk"
HOT = "_dw_hot"
_RN = "_dw_rn"
_LAST = "_dw_is_last"

DEFAULT_CHUNK_ROWS = 1_000_000
# The hot-key and carry tables are broadcast only while they hold at most this many
# chunks (checked at run time); beyond it they are joined without a hint and AQE plans
# the join from measured sizes.
MAX_BROADCAST_CHUNKS = 500_000
_BROADCAST_META = "dw_broadcast"
# Hot keys are found on a sample holding about this many rows per chunk; at or below
# this chunk size the whole input is used.
SAMPLE_ROWS_PER_CHUNK = 10_000
SAMPLE_SEED = 17
# Splitters come from about this many rows per chunk; a node of the splitters' tree has FAN - 1.
SPLIT_ROWS_PER_CHUNK = 200
SPLIT_SEED = 23
FAN = 32
_SAMPLE_SPACE = 1_000_000


def chunk_rows_of(spark, default: int = DEFAULT_CHUNK_ROWS) -> int:
    """Rows per chunk of a hot key; ``dimweave.chunkRows`` in the session overrides it."""
    return int(spark.conf.get("dimweave.chunkRows", str(default)))


def left_join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], *, broadcast: bool) -> DataFrame:
    """Left join on ``on`` where a null key matches a null key (a null key is a key
    like any other here); keeps ``left``'s key columns.  ``broadcast`` only for a
    right side of bounded size."""
    r = right.select(*[F.col(c).alias(f"_dw_r_{c}") for c in on],
                     *[c for c in right.columns if c not in on])
    cond = None
    for c in on:
        eq = left[c].eqNullSafe(r[f"_dw_r_{c}"])
        cond = eq if cond is None else cond & eq
    return left.join(F.broadcast(r) if broadcast else r, cond, "left").drop(*[f"_dw_r_{c}" for c in on])


def _sampled(df: DataFrame, columns: Sequence[str], fraction: float, salt: int) -> DataFrame:
    """Rows chosen by a hash of their columns, not by position: every branch of a plan and every
    retried task picks the same ones."""
    if fraction >= 1.0:
        return df
    h = F.pmod(F.xxhash64(*[F.col(c) for c in columns], F.lit(salt)), F.lit(_SAMPLE_SPACE))
    return df.filter(h < F.lit(max(1, int(fraction * _SAMPLE_SPACE))))


def _splitters(df: DataFrame, hot: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int) -> DataFrame:
    """(keys, _dw_i, _dw_s): for a hot key with k chunks the order tuples at the ranks 1/k, 2/k, ..
    of a sample of about ``SPLIT_ROWS_PER_CHUNK`` rows for each chunk, numbered from 1."""
    few = _sampled(df.select(*keys, *order), [*keys, *order], SPLIT_ROWS_PER_CHUNK / float(chunk_rows), SPLIT_SEED)
    h = hot.select(*[F.col(c).alias(f"_dw_h_{c}") for c in keys], "_dw_k")
    cond = F.lit(True)
    for c in keys:
        cond = cond & few[c].eqNullSafe(h[f"_dw_h_{c}"])
    few = few.join(h, cond).select(*keys, "_dw_k", F.struct(*order).alias("_dw_s"))
    w = Window.partitionBy(*keys)
    ranked = few.select("*", (F.row_number().over(w.orderBy("_dw_s")) - 1).alias("_dw_r"), F.count(F.lit(1)).over(w).alias("_dw_n"))
    chunk = lambda r: F.floor(r * F.col("_dw_k") / F.col("_dw_n"))
    return (ranked.filter((F.col("_dw_r") > 0) & (chunk(F.col("_dw_r")) > chunk(F.col("_dw_r") - 1)))
            .select(*keys, F.row_number().over(w.orderBy("_dw_s")).alias("_dw_i"), "_dw_s"))


def assign_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int) -> DataFrame:
    """Add ``_dw_chunk`` (null for ordinary keys, so that "hot rows only" is a
    predicate on a window partition column, which Spark pushes below windows and
    shuffles) and ``_dw_hot``.

    A hot key with about n rows is cut at k - 1 splitters, k = ceil(n / chunk_rows): a row's
    chunk is the number of splitters that don't come after its order tuple, so it never decreases
    along the order, and chunks hold about ``chunk_rows`` rows however the order is spread.

    n comes from a sample of about ``SAMPLE_ROWS_PER_CHUNK`` rows per chunk, the splitters from a
    thinner one.  Samples only place chunk boundaries: every row is still scanned, and any monotone
    chunking gives the same result, so an estimate that is off only changes chunk sizes.  Splitters
    are checkpointed, so no branch of the plan finds them again.

    One small action (how many hot keys and chunks does the sample show?) chooses the
    plan: with no hot key the chunk is a literal null and the carry machinery folds away;
    the hot-key and carry tables are broadcast only up to ``MAX_BROADCAST_CHUNKS``.
    """
    keys, order = list(keys), list(order)
    fraction = min(1.0, SAMPLE_ROWS_PER_CHUNK / float(chunk_rows))
    src = _sampled(df, [*keys, *order], fraction, SAMPLE_SEED)
    hot = (src.groupBy(*keys).agg((F.count(F.lit(1)) / F.lit(fraction)).alias("_dw_n")).filter(F.col("_dw_n") > F.lit(chunk_rows))
           .select(*keys, F.ceil(F.col("_dw_n") / F.lit(chunk_rows)).alias("_dw_k")))
    cols = df.columns
    size = hot.agg(F.count(F.lit(1)).alias("keys"), F.sum("_dw_k").alias("chunks"), F.max("_dw_k").alias("most")).first()
    if size["keys"] == 0:
        # No hot key: a literal null chunk.  Catalyst then folds every "hot rows only"
        # branch to an empty relation and drops the carry joins, leaving a plain window.
        return df.select(*cols, F.lit(None).cast("long").alias(CHUNK), F.lit(False).alias(HOT))
    broadcast = int(size["chunks"]) <= MAX_BROADCAST_CHUNKS
    ensure_checkpoint_dir(df.sparkSession)
    hot = hot.checkpoint()
    splits = _splitters(df, hot, keys, order, chunk_rows).checkpoint()
    # Splitters as a tree of nodes of FAN - 1: a row goes down one level at a time, so it meets few
    # of them, and no row carries a long array.
    x = left_join_null_safe(df, hot, keys, broadcast=broadcast).withColumn(CHUNK, F.when(F.col("_dw_k").isNotNull(), F.lit(0).cast("long")))
    levels = 1
    while FAN ** levels < int(size["most"]):
        levels += 1
    for level in reversed(range(levels)):
        own = splits.filter((F.col("_dw_i") % FAN ** level == 0) & (F.col("_dw_i") % FAN ** (level + 1) != 0))
        own = own.groupBy(*keys, F.floor(F.col("_dw_i") / FAN ** (level + 1)).cast("long").alias(CHUNK)).agg(
            F.collect_list("_dw_s").alias("_dw_node"))
        x = left_join_null_safe(x, own, [*keys, CHUNK], broadcast=broadcast)
        below = F.size(F.filter(F.coalesce("_dw_node", F.array().cast(own.schema["_dw_node"].dataType)), lambda s: s <= F.struct(*order)))
        x = x.withColumn(CHUNK, F.col(CHUNK) * FAN + below).drop("_dw_node")
    return x.select(*cols, F.col(CHUNK).alias(CHUNK, metadata={_BROADCAST_META: broadcast}), F.col("_dw_k").isNotNull().alias(HOT))


def keyed_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    prev: Mapping[str, Column] | None = None,
    next: Mapping[str, Column] | None = None,  # noqa: A002 - mirrors lag/lead
    last_before: Mapping[str, Column] | None = None,
    first_before: Mapping[str, Column] | None = None,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    chunked: bool = False,
) -> DataFrame:
    """Per key, in ``order``, add for every row:

    * ``prev[name]``: the expression's value on the previous row (null on the first);
    * ``next[name]``: its value on the next row (null on the last);
    * ``last_before[name]``: the latest non-null value on an earlier row;
    * ``first_before[name]``: the earliest non-null value on an earlier row.

    ``order`` must be unique within a key.  The result keeps ``_dw_chunk``/``_dw_hot``
    (drop them with :func:`drop_scan_columns`); pass ``chunked=True`` to scan a subset
    of an earlier scan's rows without another shuffle.
    """
    prev, nxt = dict(prev or {}), dict(next or {})
    lastb, firstb = dict(last_before or {}), dict(first_before or {})
    if not (prev or nxt or lastb or firstb):
        raise ValueError("keyed_scan needs at least one output")
    if not chunked:
        df = assign_chunks(df, keys, order, chunk_rows)
    base_cols = df.columns
    part = [*keys, CHUNK]
    w = Window.partitionBy(*part).orderBy(*order)
    w_before = w.rowsBetween(Window.unboundedPreceding, -1)

    # Values are wrapped in a one-field struct so that "no row" (null struct) and
    # "a row whose value is null" stay apart in lag/lead.
    def wrap(c: Column) -> Column:
        return F.struct(c.alias("v"))

    win_cols = [F.row_number().over(w).alias(_RN), F.lead(F.lit(1)).over(w).isNull().alias(_LAST)]
    for name, c in prev.items():
        win_cols.append(F.lag(wrap(c)).over(w).alias(f"_p_{name}"))
    for name, c in nxt.items():
        win_cols.append(F.lead(wrap(c)).over(w).alias(f"_n_{name}"))
    for name, c in lastb.items():
        win_cols.append(F.last(c, ignorenulls=True).over(w_before).alias(f"_lb_{name}"))
    for name, c in firstb.items():
        win_cols.append(F.first(c, ignorenulls=True).over(w_before).alias(f"_fb_{name}"))
    win = df.select("*", *win_cols)

    # Carry table, built from the rows of hot keys before the window: one partially
    # aggregated row per chunk (its first and last value, its first and last non-null
    # value), so only hot chunks' summaries cross the network, never the rows.
    ostruct = F.struct(*order)
    aggs = []
    for n, c in prev.items():
        aggs.append(F.max_by(wrap(c), ostruct).alias(f"_t_{n}"))
    for n, c in nxt.items():
        aggs.append(F.min_by(wrap(c), ostruct).alias(f"_h_{n}"))
    for n, c in lastb.items():
        aggs.append(F.max_by(c, F.when(c.isNotNull(), ostruct)).alias(f"_tl_{n}"))
    for n, c in firstb.items():
        aggs.append(F.min_by(c, F.when(c.isNotNull(), ostruct)).alias(f"_hf_{n}"))
    summary = df.filter(F.col(CHUNK).isNotNull()).groupBy(*part).agg(*aggs)
    wc = Window.partitionBy(*keys).orderBy(CHUNK)
    wc_before = wc.rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = []
    for n in prev:
        carry_cols.append(F.lag(F.col(f"_t_{n}")).over(wc).alias(f"_cp_{n}"))
    for n in nxt:
        carry_cols.append(F.lead(F.col(f"_h_{n}")).over(wc).alias(f"_cn_{n}"))
    for n in lastb:
        carry_cols.append(F.last(F.col(f"_tl_{n}"), ignorenulls=True).over(wc_before).alias(f"_clb_{n}"))
    for n in firstb:
        carry_cols.append(F.first(F.col(f"_hf_{n}"), ignorenulls=True).over(wc_before).alias(f"_cfb_{n}"))
    # Hot keys only, one row per chunk: bounded by rows / chunk_rows and checked in
    # assign_chunks.  Ordinary keys (null chunk) find no carry row, as they need none.
    carry = summary.select(*part, *carry_cols)
    broadcast = df.schema[CHUNK].metadata.get(_BROADCAST_META, False)
    joined = left_join_null_safe(win, carry, part, broadcast=broadcast)

    out = [F.col(c) for c in base_cols]
    first_row, last_row = F.col(_RN) == 1, F.col(_LAST)
    for n in prev:
        out.append(F.when(first_row, F.col(f"_cp_{n}")).otherwise(F.col(f"_p_{n}"))["v"].alias(n))
    for n in nxt:
        out.append(F.when(last_row, F.col(f"_cn_{n}")).otherwise(F.col(f"_n_{n}"))["v"].alias(n))
    for n in lastb:
        out.append(F.coalesce(F.col(f"_lb_{n}"), F.col(f"_clb_{n}")).alias(n))
    for n in firstb:
        out.append(F.coalesce(F.col(f"_cfb_{n}"), F.col(f"_fb_{n}")).alias(n))
    return joined.select(*out)


def drop_scan_columns(df: DataFrame) -> DataFrame:
    return df.drop(CHUNK, HOT)
