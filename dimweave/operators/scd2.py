"""Versioned (SCD type 2) dimensions from change events.

``scd2_versions`` turns ordered events into versions with opening and closing bounds,
on top of an existing dimension (the seed).  It is set-based: one pass
(``changes.change_points``) keeps the rows that change something and finds where each
version ends, with a single shuffle of the rows, hot keys included.

Close rules:

* ``standard``: a version ends where the next version of its key begins; versions
  closed before this load keep their ends.
* ``all_rows``: the source system's behaviour.  Each change re-stamps the end of
  *every* row of the key, so after a load every row of a changed key except the newest
  carries the newest version's start.  A change only stamps when the key already had a
  row at that moment (``stamp_when="any"``: any row; ``"open"``: an open row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.operators.changes import change_points
from dimweave.operators.ordered import DEFAULT_CHUNK_ROWS, drop_scan_columns, left_join_null_safe
from dimweave.session import ensure_checkpoint_dir

SEED = "_dw_seed"
PRIOR = "_dw_prior"
RANK = "_dw_rank"  # tie-break at equal order: seed row, then prior event, then events
NEXT = "_dw_next"
IS_NEW = "is_new"
TOUCHED = "_dw_touched"


def _fill_missing(df: DataFrame, like: DataFrame, cols: Sequence[str]) -> DataFrame:
    types = dict((f.name, f.dataType) for f in like.schema.fields)
    for c in cols:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(types[c]))
    return df


def scd2_versions(
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    compare: Sequence[str],
    columns: Sequence[str],
    *,
    bounds: Sequence[str] | None = None,
    seed: DataFrame | None = None,
    prior: DataFrame | None = None,
    compare_with_seed: bool = True,
    close: str = "standard",
    stamp_when: str = "any",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """Versions of a dimension after applying ``events``.

    events: keys, ``bounds`` (default ``order``; ``order`` must be among them),
        ``compare`` and ``columns``.
    seed: the existing dimension: keys, ``columns``, ``eff_<b>`` and ``end_<b>`` for
        each bound b (open rows have a null ``end_<order[0]>``).  With
        ``compare_with_seed=False`` the first event of a key always opens a version
        (the comparison state starts empty), otherwise it is compared with the open
        seed row.
    prior: the last event already applied per key (columns as ``events``); it is the
        comparison's row 0 for the key and never becomes a version.  Streams carry it
        from one micro-batch to the next.

    Returns keys, ``columns``, ``eff_<b>``, ``end_<b>``, ``is_new`` (made by this
    load) and ``_dw_touched`` (end set or changed by this load).
    """
    keys, order, compare, columns = list(keys), list(order), list(compare), list(columns)
    bounds = list(bounds or order)
    body = list(dict.fromkeys(compare + columns))
    ev = events.select(*keys, *bounds, *body, F.lit(False).alias(SEED), F.lit(False).alias(PRIOR),
                       F.lit(2).alias(RANK))
    closed_seed = None
    rows = ev
    if prior is not None:
        pr = prior.select(*keys, *bounds, *[c for c in body if c in prior.columns])
        pr = _fill_missing(pr, ev, body).select(*keys, *bounds, *body, F.lit(False).alias(SEED),
                                                F.lit(True).alias(PRIOR), F.lit(1).alias(RANK))
        rows = rows.unionByName(pr)
    if seed is not None:
        o_end = F.col(f"end_{order[0]}")
        open_seed = seed.filter(o_end.isNull()).select(
            *keys, *[F.col(f"eff_{b}").alias(b) for b in bounds],
            *[c for c in body if c in seed.columns], F.lit(True).alias(SEED), F.lit(False).alias(PRIOR),
            F.lit(0).alias(RANK))
        rows = rows.unionByName(_fill_missing(open_seed, ev, body).select(*ev.columns))
        closed_seed = _fill_missing(seed.filter(o_end.isNotNull()), ev, columns)

    cmp = compare if compare_with_seed or seed is None else [*compare, SEED]
    order_ext = [*order, RANK]
    # Versions and where each ends, in one row shuffle (prior rows only feed the comparison).
    versions = drop_scan_columns(change_points(rows, keys, order_ext, cmp, bounds=bounds, skip=PRIOR,
                                               next_name=NEXT, chunk_rows=chunk_rows))

    out_cols = [*keys, *columns]
    eff = [F.col(b).alias(f"eff_{b}") for b in bounds]
    if close == "standard":
        res = versions.select(
            *out_cols, *eff, *[F.col(NEXT)[b].alias(f"end_{b}") for b in bounds],
            (~F.col(SEED)).alias(IS_NEW), F.col(NEXT).isNotNull().alias(TOUCHED))
        if closed_seed is not None:
            res = res.unionByName(closed_seed.select(
                *out_cols, *[f"eff_{b}" for b in bounds], *[f"end_{b}" for b in bounds],
                F.lit(False).alias(IS_NEW), F.lit(False).alias(TOUCHED)))
        return res
    if close != "all_rows":
        raise ValueError(f"unknown close rule {close!r}")

    allv = versions.select(*out_cols, *eff, *[F.lit(None).cast(versions.schema[b].dataType).alias(f"end_{b}")
                                              for b in bounds], (~F.col(SEED)).alias(IS_NEW))
    if closed_seed is not None:
        allv = allv.unionByName(closed_seed.select(
            *out_cols, *[f"eff_{b}" for b in bounds], *[f"end_{b}" for b in bounds], F.lit(False).alias(IS_NEW)))
    # The versions feed both the per-key summary and the final rows: materialise them
    # once in the shared checkpoint folder instead of running the scans twice.
    ensure_checkpoint_dir(allv.sparkSession)
    allv = allv.checkpoint(eager=True)
    # Per key: newest new version, number of new versions, and whether a row existed
    # before the load.  Aggregation with a map-side partial step.
    eff_struct = F.struct(*[F.col(f"eff_{b}") for b in bounds])
    existed = (~F.col(IS_NEW)) if stamp_when == "any" else ((~F.col(IS_NEW)) & F.col(f"end_{order[0]}").isNull())
    info = allv.groupBy(*keys).agg(
        F.max_by(F.when(F.col(IS_NEW), eff_struct), F.when(F.col(IS_NEW), F.struct(*[F.col(f"eff_{o}") for o in order]))
                 ).alias("_dw_newest"),
        F.sum(F.col(IS_NEW).cast("int")).alias("_dw_n_new"),
        F.max(existed.cast("int")).alias("_dw_existed"),
    )
    x = left_join_null_safe(allv, info, keys, broadcast=False)
    newest = F.col("_dw_newest")
    is_newest = F.col(IS_NEW) & eff_struct.eqNullSafe(newest)
    stamp = (F.col("_dw_n_new") >= 1) & ((F.col("_dw_n_new") >= 2) | (F.col("_dw_existed") == 1)) & ~is_newest
    return x.select(
        *out_cols, *[f"eff_{b}" for b in bounds],
        *[F.when(stamp, newest[f"eff_{b}"]).otherwise(F.col(f"end_{b}")).alias(f"end_{b}") for b in bounds],
        F.col(IS_NEW), stamp.alias(TOUCHED))
