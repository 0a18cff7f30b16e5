"""Change detection: keep a row only when it differs from the previous row of its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.operators.ordered import CHUNK, DEFAULT_CHUNK_ROWS, assign_chunks, keyed_scan, left_join_null_safe

_PREV = "_dw_prev_cmp"


def changed_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    compare: Sequence[str],
    *,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    chunked: bool = False,
) -> DataFrame:
    """Rows whose ``compare`` columns differ, null-safely, from the previous row of the
    same key in ``order``; the first row of every key is kept.  This is the set form of
    "compare with the last event kept in keyed state": an unchanged row equals the
    state, so the previous row always holds the state's values.

    The result keeps the scan's chunk columns so a following scan needs no shuffle.
    """
    cmp = F.struct(*[F.col(c) for c in compare])
    x = keyed_scan(df, keys, order, prev={_PREV: cmp}, chunk_rows=chunk_rows, chunked=chunked)
    return x.filter(~F.col(_PREV).eqNullSafe(cmp)).drop(_PREV)


def change_points(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    compare: Sequence[str],
    *,
    bounds: Sequence[str],
    skip: str | None = None,
    next_name: str = "_dw_next",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """The rows ``changed_rows`` keeps (minus those where ``skip`` is true), each with
    ``next_name`` = ``bounds`` of the key's next such row (null for the last): the
    versions of an SCD2 dimension and where each one ends, in one row shuffle.

    Hot keys are chunked as in ``keyed_scan``.  What a chunk needs from later chunks
    (their first change) comes from pre-window partial aggregates: before its first
    change every row of a chunk equals the chunk's first row, so the first change is the
    first row that differs from that head row (found with a broadcast join to the
    bounded head table and a map-side ``min_by``), or the head itself when it differs
    from the previous chunk's last row.  ``skip`` rows may only open a key (they are
    the comparison's row 0, after at most one seed row), so they lie in the key's first
    chunk, whose first change no other chunk needs, or head the next chunk, which the
    head rule handles.
    """
    keys, order, compare, bounds = list(keys), list(order), list(compare), list(bounds)
    df = assign_chunks(df, keys, order, chunk_rows)
    broadcast = df.schema[CHUNK].metadata.get("dw_broadcast", False)
    part = [*keys, CHUNK]
    cmp, bnd, ostruct = F.struct(*compare), F.struct(*bounds), F.struct(*order)
    skipped = F.col(skip) if skip else F.lit(False)

    # Per hot chunk: head (first row) and tail (last row) values, pre-window.
    hot = df.filter(F.col(CHUNK).isNotNull())
    ends = hot.groupBy(*part).agg(
        F.min_by(F.struct(cmp.alias("c"), bnd.alias("b"), skipped.alias("s")), ostruct).alias("_dw_head"),
        F.max_by(F.struct(cmp.alias("c")), ostruct).alias("_dw_tail"))
    # First row of each hot chunk that differs from the chunk's head row.
    heads = ends.select(*part, F.col("_dw_head.c").alias("_dw_hc"))
    diffs = (left_join_null_safe(hot, heads, part, broadcast=broadcast)
             .filter(~cmp.eqNullSafe(F.col("_dw_hc")))
             .groupBy(*part).agg(F.min_by(bnd, ostruct).alias("_dw_diff")))
    wc = Window.partitionBy(*keys).orderBy(CHUNK)
    chunks = (left_join_null_safe(ends, diffs, part, broadcast=broadcast)
              .withColumn("_dw_prev_tail", F.lag("_dw_tail").over(wc)))
    head_kept = ((F.col("_dw_prev_tail").isNull() | ~F.col("_dw_head.c").eqNullSafe(F.col("_dw_prev_tail.c")))
                 & ~F.col("_dw_head.s"))
    chunks = chunks.withColumn("_dw_first", F.when(head_kept, F.col("_dw_head.b")).otherwise(F.col("_dw_diff")))
    # The next chunk's first change: over the reversed order a running frame, which Spark
    # extends row by row (a frame that shrinks towards the end would be summed anew for each).
    back = Window.partitionBy(*keys).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.select(*part, "_dw_prev_tail",
                          F.last("_dw_first", ignorenulls=True).over(back).alias("_dw_next_chunk"))

    base_cols = df.columns
    w = Window.partitionBy(*part).orderBy(*order)
    win = df.select("*", F.row_number().over(w).alias("_dw_rn"), F.lag(F.struct(cmp.alias("c"))).over(w).alias("_dw_p"))
    x = left_join_null_safe(win, carry, part, broadcast=broadcast)
    prev = F.when(F.col("_dw_rn") == 1, F.col("_dw_prev_tail")).otherwise(F.col("_dw_p"))
    kept = (prev.isNull() | ~prev["c"].eqNullSafe(cmp)) & ~skipped
    # A kept row ends where the next kept row of its chunk begins: the same partitioning and
    # order again, so no further shuffle, and time linear in the rows of a key.
    x = x.filter(kept)
    within = F.lead(bnd).over(w)
    return x.select(*base_cols, F.coalesce(within, F.col("_dw_next_chunk")).alias(next_name))
