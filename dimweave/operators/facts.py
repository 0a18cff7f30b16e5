"""Teller transactions -> fact rows, with the customer's dimension key looked up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.functions.expressions import yyyymmdd_to_date
from dimweave.operators.lookups import dedupe_lookup
from dimweave.operators.ordered import DEFAULT_CHUNK_ROWS, drop_scan_columns, keyed_scan
from dimweave.schemas import MONEY

LCY_DECIMAL = "decimal(38,6)"  # amount x rate keeps 6 decimals

# Target fact column <- teller field (our reading of the two layouts).
#   txn_ccy      <- currency1
#   product_code <- transactionCode
#   trn_ref_no   <- id
#   txn_amount   <- amountFcy1
#   lcy_amount   <- amountFcy1 * coalesce(rate2, 1)
#   cst_dim_id   <- dimension key of customer2 (null when the customer is unknown)
#   record_stat  <- opType
#   auth_stat    <- "A" when authoriser is set, else "U"
#   txn_acc      <- account1
#   ofs_acc      <- account2
#   trn_dt       <- valueDate2 read as yyyyMMdd
#   etl_date     <- the load date (a parameter, never the wall clock)
AUTHORISED, UNAUTHORISED = "A", "U"


def fact_columns(load_date: str) -> dict[str, Column]:
    # Money is computed in decimal and becomes a double (the fact's type) only at the end.
    amount = F.col("amountFcy1").cast(MONEY)
    lcy = (amount * F.coalesce(F.col("rate2").cast(MONEY), F.lit(1).cast(MONEY))).cast(LCY_DECIMAL)
    return {
        "txn_ccy": F.col("currency1"),
        "product_code": F.col("transactionCode"),
        "trn_ref_no": F.col("id").cast("string"),
        "lcy_amount": lcy.cast("double"),
        "txn_amount": amount.cast("double"),
        "record_stat": F.col("opType"),
        "auth_stat": F.when(F.col("authoriser").isNotNull(), F.lit(AUTHORISED)).otherwise(F.lit(UNAUTHORISED)),
        "txn_acc": F.col("account1"),
        "ofs_acc": F.col("account2"),
        "trn_dt": yyyymmdd_to_date(F.col("valueDate2")),
        "etl_date": F.lit(load_date).cast("date"),
    }


def teller_to_fact(tellers: DataFrame, customer_dim: DataFrame, *, dim_key: str, dim_id: str,
                   load_date: str) -> DataFrame:
    """Map teller rows to the fact layout; ``cst_dim_id`` from ``customer_dim``
    (``dim_key`` -> ``dim_id``, one row per key)."""
    lk = dedupe_lookup(customer_dim.select(F.col(dim_key).cast("string").alias("_dw_ck"),
                                           F.col(dim_id).alias("cst_dim_id")), ["_dw_ck"])
    x = tellers.join(lk, tellers["customer2"].cast("string") == lk["_dw_ck"], "left")
    return _fact_rows(x, load_date)


def _fact_rows(x: DataFrame, load_date: str) -> DataFrame:
    cols = fact_columns(load_date)
    ordered = ["txn_ccy", "product_code", "trn_ref_no", "lcy_amount", "txn_amount", "cst_dim_id",
               "record_stat", "auth_stat", "txn_acc", "ofs_acc", "trn_dt", "etl_date"]
    return x.select(*[(cols[c].alias(c) if c in cols else F.col(c)) for c in ordered])


def key_in_force(rows: DataFrame, versions: DataFrame, *, key: Column, at: Column, version_key: str, begins: str, ends: str,
                 value: str, out: str, missing: Column | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``rows`` with ``out``: ``value`` of the version of their key that is in force at ``at``.

    A version holds from ``begins`` (null: since ever) until before ``ends`` (null: open).  Where
    versions of a key overlap, the one that began last decides, at one begin the one with the
    largest ``value``.  Rows without a version in force (unknown key, the key's first version begins
    later, a gap, null key or place) get ``missing``; a key that comes later is so told by its
    member.  Keys are compared as text; a null key meets no version.

    Versions and rows meet in one keyed scan, one shuffle and no range join, and a hot key is cut
    into chunks."""
    kind = versions.schema[value].dataType
    v = versions.filter(F.col(version_key).isNotNull()).select(
        F.col(version_key).cast("string").alias("_dw_key"), F.col(begins).alias("_dw_at"), F.lit(False).alias("_dw_asks"),
        F.col(value).alias("_dw_value"), F.col(ends).alias("_dw_end"))
    asked = rows.select(key.cast("string").alias("_dw_key"), at.cast(versions.schema[begins].dataType).alias("_dw_at"),
                        F.lit(True).alias("_dw_asks"), F.lit(None).cast(kind).alias("_dw_value"),
                        F.struct(*rows.columns).alias("_dw_own"))
    held = F.when(~F.col("_dw_asks"), F.struct("_dw_value", "_dw_end"))
    x = keyed_scan(v.unionByName(asked, allowMissingColumns=True), ["_dw_key"], ["_dw_at", "_dw_asks", "_dw_value"],
                   last_before={"_dw_in": held}, chunk_rows=chunk_rows)
    x = drop_scan_columns(x).filter("_dw_asks")
    in_force = (F.col("_dw_in").isNotNull() & F.col("_dw_at").isNotNull()
                & (F.col("_dw_in._dw_end").isNull() | (F.col("_dw_at") < F.col("_dw_in._dw_end"))))
    other = F.lit(None) if missing is None else missing
    return x.select("_dw_own.*", F.when(in_force, F.col("_dw_in._dw_value")).otherwise(other.cast(kind)).alias(out))


def teller_to_fact_at(tellers: DataFrame, customer_versions: DataFrame, *, dim_key: str, dim_id: str, begins: str, ends: str,
                      load_date: str, missing: int | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """The fact layout with the key of the customer's version in force on the transaction's date;
    ``missing``: the member for customers without one (see ``key_in_force``)."""
    x = key_in_force(tellers, customer_versions, key=F.col("customer2"), at=yyyymmdd_to_date(F.col("valueDate2")),
                     version_key=dim_key, begins=begins, ends=ends, value=dim_id, out="cst_dim_id", missing=F.lit(missing),
                     chunk_rows=chunk_rows)
    return _fact_rows(x, load_date)
