"""The loaders, wired from the generic operators: account and product dimensions, rate
updates and the transaction fact.  Inputs are DataFrames in the stand-in layouts of
``plans.fixtures`` (snake_case events with an order column ``seq`` and a time ``ts``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.functions.expressions import (
    account_record_stat,
    account_type,
    flexible_date,
    product_record_stat,
    rate_from_text,
    term_bucket,
)
from dimweave.operators.lookups import Lookup, current_versions, priority_lookup
from dimweave.operators.ordered import DEFAULT_CHUNK_ROWS, keyed_scan, left_join_null_safe
from dimweave.operators.rates import rates_by_version, rates_final
from dimweave.operators.scd2 import IS_NEW, TOUCHED, scd2_versions
from dimweave.schemas import DIM_ACCOUNT_COLUMNS, MONEY
from dimweave.session import ensure_checkpoint_dir

ACCOUNT_KEY, PRODUCT_KEY = "id", "product_no"
ORDER, BOUNDS = ["seq"], ["seq", "ts"]
#: Every field of an account event besides its key: a difference in any opens a version.
ACCOUNT_COMPARE = ["customer", "prt_code", "ccy", "open_val_date_bal", "maturity_date", "op_type", "working_balance",
                   "account_class", "category", "co_code"]
ACCOUNT_COLUMNS = ["account_type", "ccy", "cr_gl", "maturity_date", "rate", "record_stat", "account_class", "act_f"]
PRODUCT_ATTRS = ["product_category", "product_code", "product_type", "record_stat"]
CR_GL = "1"


# ------------------------------------------------------------------ accounts
def account_rows(events: DataFrame) -> DataFrame:
    """Account events -> dimension-row values (PRJ: currency->ccy, id->account_no)."""
    for name, kind in (("maturity_date", "date"), ("account_class", "string")):
        if name not in events.columns:
            events = events.withColumn(name, F.lit(None).cast(kind))
    return events.select(
        "*", F.lit(None).cast(MONEY).alias("act_f"), account_type("prt_code").alias("account_type"), F.lit(CR_GL).alias("cr_gl"),
        account_record_stat("op_type").alias("record_stat"))


def account_events_from_messages(decoded: DataFrame) -> DataFrame:
    """Decoded account messages (entity field names) -> the account event layout
    (id, prt_code, ccy, op_type, maturity_date, account_class, ...)."""
    return decoded.select(
        "*", F.col("prtCode").alias("prt_code"), F.col("currency").alias("ccy"), F.col("opType").alias("op_type"),
        flexible_date("dateMaturity").alias("maturity_date"), F.col("allInOneProduct").alias("account_class"),
        F.col("openValDateBal").alias("open_val_date_bal"), F.col("workingBalance").alias("working_balance"),
        F.col("coCode").alias("co_code"))


def account_rate_lookups(az: DataFrame, accr: DataFrame) -> list[Lookup]:
    """First table: a numeric rate by id; second: rate text by account number."""
    return [Lookup(az, "id", F.col("interest_rate").cast(MONEY)),
            Lookup(accr, "account_number", rate_from_text("cr_int_rate"))]


def account_versions(events: DataFrame, seed: DataFrame | None, az: DataFrame, accr: DataFrame, *,
                     close: str = "standard", chunk_rows: int = DEFAULT_CHUNK_ROWS,
                     prior: DataFrame | None = None, extra_columns: tuple[str, ...] = (),
                     compare: list[str] | None = None, order: list[str] = ORDER,
                     bounds: list[str] = BOUNDS) -> DataFrame:
    """The account dimension after ``events``: a new version per event that differs
    from the key's previous event (the existing dimension takes no part in that
    comparison), with the rate from the first lookup table that has the account.
    ``compare``: by default every event field that ``events`` has."""
    ev = account_rows(events).withColumn("rate", F.lit(None).cast(MONEY))
    compare = compare or [c for c in ACCOUNT_COMPARE if c in events.columns]
    v = scd2_versions(ev, [ACCOUNT_KEY], order, compare, [*ACCOUNT_COLUMNS, *extra_columns], bounds=bounds,
                      seed=seed, prior=prior, compare_with_seed=False, close=close, stamp_when="any",
                      chunk_rows=chunk_rows)
    # New versions take the looked-up rate; existing rows keep theirs.  One pass over
    # the versions (a union of two filtered copies would run the whole plan twice).
    x = priority_lookup(v, ACCOUNT_KEY, account_rate_lookups(az, accr), "_dw_rate")
    return x.withColumn("rate", F.when(F.col(IS_NEW), F.col("_dw_rate")).otherwise(F.col("rate"))).drop("_dw_rate")


def rated_account_versions(events: DataFrame, seed: DataFrame | None, az: DataFrame, accr: DataFrame, rates: DataFrame, *,
                           chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """The account dimension after account events and rate events (account_no, seq, rate, source),
    taken together in the order of ``seq``, the account event first at equal places: a new version
    begins with the looked-up rate, and a rate event acts on the version then in force."""
    ensure_checkpoint_dir(events.sparkSession)
    v = account_versions(events, seed, az, accr, chunk_rows=chunk_rows).checkpoint()  # read by the scan and by the join
    return rates_by_version(v, rates, key="account_no", order=ORDER, dim_key=ACCOUNT_KEY, chunk_rows=chunk_rows)


def in_layout(df: DataFrame, layout: list[tuple[str, str | None]]) -> DataFrame:
    """The warehouse's columns, in its order, in front of the others; decimals as double."""
    names = [n for n, _ in layout]
    own = [F.col(n).cast("double").alias(n) if (t or "").startswith("decimal") else F.col(n) for n, t in layout]
    return df.select(*own, *[c for c in df.columns if c not in names])


def account_dimension_layout(v: DataFrame, update_tms: Column | None = None, is_new: str = IS_NEW) -> DataFrame:
    """The twelve warehouse columns, with the version's order bounds and whether it is new."""
    stamp = F.when(F.col(TOUCHED), F.col("end_ts")) if update_tms is None else update_tms
    return in_layout(v.select(
        F.col(ACCOUNT_KEY).alias("account_no"), *ACCOUNT_COLUMNS, "eff_seq", "end_seq",
        F.col("eff_ts").alias("eff_dt"), F.col("end_ts").alias("end_dt"), stamp.alias("update_tms"),
        F.col(is_new).alias(IS_NEW)), DIM_ACCOUNT_COLUMNS)


# ------------------------------------------------------------------ products
def product_rows(events: DataFrame) -> DataFrame:
    """Product events -> dimension-row values (category->product_code,
    sub_product->product_type, term bucket -> product_category)."""
    return events.select(
        PRODUCT_KEY, "seq", "ts", term_bucket("loc_term").alias("product_category"),
        F.col("category").alias("product_code"), F.col("sub_product").alias("product_type"),
        product_record_stat("op_type").alias("record_stat"))


def product_events_from_messages(decoded: DataFrame) -> DataFrame:
    """Decoded product messages (entity field names, ``seq``, ``ts``) -> the product event layout."""
    return decoded.select("seq", "ts", F.col("productNo").alias("product_no"), F.col("locTerm").alias("loc_term"), "category",
                          F.col("subProduct").alias("sub_product"), F.col("opType").alias("op_type"))


def product_versions(events: DataFrame, seed: DataFrame | None, *, chunk_rows: int = DEFAULT_CHUNK_ROWS,
                     close: str = "standard") -> DataFrame:
    """The product dimension after ``events``: a new version whenever the four derived
    values differ from the current version (the open seed row, or the last new one)."""
    return scd2_versions(product_rows(events), [PRODUCT_KEY], ORDER, PRODUCT_ATTRS, PRODUCT_ATTRS,
                         bounds=BOUNDS, seed=seed, compare_with_seed=True, close=close, stamp_when="open",
                         chunk_rows=chunk_rows)


def product_dimension_layout(v: DataFrame) -> DataFrame:
    return v.select(
        PRODUCT_KEY, *PRODUCT_ATTRS, "eff_seq", "end_seq", F.col("eff_ts").alias("eff_dt"),
        F.col("end_ts").alias("end_dt"), F.when(F.col(TOUCHED), F.col("end_ts")).alias("update_tms"), IS_NEW)


def product_actions(events: DataFrame, dim: DataFrame, *, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """For every event: INSERT, REPLACE or NONE against the version that is current when it
    comes, which holds the values of the event before it (or of the dimension's open row)."""
    rows = product_rows(events).withColumn("_dw_open", F.lit(False))
    cur = current_versions(dim, [PRODUCT_KEY], "end_seq", ["eff_seq"])
    cur = cur.select(PRODUCT_KEY, F.lit(None).cast(rows.schema["seq"].dataType).alias("seq"),
                     F.lit(None).cast(rows.schema["ts"].dataType).alias("ts"), *PRODUCT_ATTRS, F.lit(True).alias("_dw_open"))
    new = F.struct(*PRODUCT_ATTRS)
    x = keyed_scan(rows.unionByName(cur), [PRODUCT_KEY], ORDER, prev={"_dw_cur": F.struct(new.alias("v"))},
                   chunk_rows=chunk_rows)
    action = (F.when(F.col("_dw_cur").isNull(), "INSERT").when(F.col("_dw_cur.v").eqNullSafe(new), "NONE")
              .otherwise("REPLACE"))
    return x.filter(~F.col("_dw_open")).select(PRODUCT_KEY, "seq", action.alias("action"))


def account_rates(dim: DataFrame, events: DataFrame) -> DataFrame:
    """The account dimension (any number of versions per account) after normalised rate
    events (account_no, seq, rate, source): the current version takes the rate, closed
    versions keep theirs."""
    cur = current_versions(dim, [ACCOUNT_KEY], "end_seq", ["eff_seq"]).select(ACCOUNT_KEY, "eff_seq", "rate")
    final = rates_final(events, cur, key="account_no", order=ORDER, dim_key=ACCOUNT_KEY, dim_rate="rate")
    final = left_join_null_safe(cur.select(F.col(ACCOUNT_KEY).alias("_dw_k"), F.col("eff_seq").alias("_dw_eff")),
                                final.select(F.col("account_no").alias("_dw_k"), F.col("rate").alias("_dw_rate")), ["_dw_k"],
                                broadcast=False)
    here = dim[ACCOUNT_KEY].eqNullSafe(final["_dw_k"]) & (dim["eff_seq"] == final["_dw_eff"]) & dim["end_seq"].isNull()
    x = dim.join(final, here, "left")
    return x.withColumn("rate", F.when(F.col("_dw_eff").isNotNull(), F.col("_dw_rate")).otherwise(F.col("rate"))).select(*dim.columns)
