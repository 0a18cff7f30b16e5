"""Keyed lookups: de-duplicated lookup tables, existence flags, priority lookups and
current versions.  All are equi-joins left to Catalyst/AQE (broadcast when the measured
side is small, sort-merge otherwise, with skewed partitions split); de-duplication is an
aggregation with a map-side partial step, so a hot lookup key is combined before the
shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe_lookup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row that is first in ``order`` (default: all other columns),
    so that duplicate keys give a stated, repeatable answer."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    order_cols = list(order) if order else others
    pick = F.min_by(F.struct(*others), F.struct(*order_cols))
    return df.groupBy(*keys).agg(pick.alias("_dw_row")).select(*keys, "_dw_row.*")


def flag_known(df: DataFrame, keys: Sequence[str], table: DataFrame, table_keys: Sequence[str],
               flag: str = "known") -> DataFrame:
    """``flag`` = the key has at least one row (any version) in ``table``."""
    present = (table.select(*[F.col(t).alias(k) for k, t in zip(keys, table_keys)])
               .distinct().withColumn("_dw_hit", F.lit(True)))
    return (df.join(present, list(keys), "left")
            .withColumn(flag, F.coalesce(F.col("_dw_hit"), F.lit(False))).drop("_dw_hit"))


@dataclass(frozen=True)
class Lookup:
    """A lookup source: ``table`` keyed by ``key`` giving ``value`` (an expression over
    the table).  ``order`` picks the row when a key repeats."""

    table: DataFrame
    key: str
    value: Column
    order: tuple[str, ...] | None = None


def priority_lookup(df: DataFrame, key: str, sources: Sequence[Lookup], out: str) -> DataFrame:
    """``out`` = value from the first source that has a *row* for the key (even when
    that row's value is null), else from the next, else null.  Unlike ``coalesce``, a
    null in an earlier source wins over a value in a later one.

    The sources become one table with the source's number in front of the value, one row is
    picked per key, and ``df`` is joined once, so a hot key of ``df`` is split by
    Spark's skew join."""
    table = None
    for i, lk in enumerate(sources):
        t = lk.table.select(F.col(lk.key).alias("_dw_k"), lk.value.alias("_dw_v"), *(lk.order or ()))
        if lk.order:
            t = dedupe_lookup(t, ["_dw_k"], lk.order)
        t = t.select("_dw_k", F.lit(i).alias("_dw_s"), "_dw_v")
        table = t if table is None else table.unionByName(t)
    pick = F.min_by(F.struct("_dw_v"), F.struct("_dw_s", "_dw_v")).alias("_dw_p")
    best = table.groupBy("_dw_k").agg(pick)
    return (df.join(best, F.col(key) == F.col("_dw_k"), "left")
            .withColumn(out, F.col("_dw_p._dw_v")).drop("_dw_k", "_dw_p"))


def current_versions(dim: DataFrame, keys: Sequence[str], end_col: str, eff_order: Sequence[str]) -> DataFrame:
    """Rows with an open end (``end IS NULL``), one per key (the latest effective one)."""
    open_rows = dim.filter(F.col(end_col).isNull())
    others = [c for c in dim.columns if c not in keys]
    pick = F.max_by(F.struct(*others), F.struct(*eff_order))
    return open_rows.groupBy(*keys).agg(pick.alias("_dw_row")).select(*keys, "_dw_row.*")
