"""The query catalogue: one Spark query per operator family, each with its DuckDB twin.

Spark side: ``QUERIES[name](spark, sf_dir) -> DataFrame``.  Oracle side:
``ORACLE_SQL[name]``, plain SQL over the given tables (the stand-in views are inlined
as CTEs).  Column names and types agree between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.functions.expressions import rate_from_text
from dimweave.operators.facts import teller_to_fact, teller_to_fact_at
from dimweave.operators.keys import assign_surrogate_keys
from dimweave.operators.lookups import flag_known, priority_lookup
from dimweave.operators.changes import changed_rows
from dimweave.operators.ordered import chunk_rows_of, drop_scan_columns
from dimweave.operators.rates import (
    FILL,
    OVERWRITE,
    normalise_rate_events,
    rate_events,
    rates_before,
    rates_final,
)
from dimweave.operators.scd2 import IS_NEW, TOUCHED
from dimweave.plans import fixtures as fx
from dimweave.plans import jobs
from dimweave.schemas import (
    ACCOUNT_EVENT,
    DIM_ACCOUNT_COLUMNS,
    DIM_PRODUCT_COLUMNS,
    FACT_TRANSACTION_COLUMNS,
    PRODUCT_EVENT,
    RATE_FILL_EVENT,
    RATE_OVERWRITE_EVENT,
    TELLER_EVENT,
)
from dimweave.sources.messages import decode, message_text
from dimweave.sources.tables import driver_table
from dimweave.streaming.sinks import messages

Query = Callable[[SparkSession, str], DataFrame]

PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])
SURROGATE_START, SURROGATE_BUCKETS = 1000, 8
#: The customer dimension's member for facts whose customer has no version in force.
MISSING_MEMBER = -1


# ------------------------------------------------------------------ sources
def q01_decode_messages(spark: SparkSession, d: str) -> DataFrame:
    good, _ = decode(driver_table(spark, d, "events"), "props", PROPS_SCHEMA, keep=["event_id"])
    return good


def _cut_messages(spark: SparkSession, d: str) -> DataFrame:
    e = driver_table(spark, d, "events")
    cut = F.expr("substring(props, 1, length(props) - 1)")
    return e.select("event_id", F.when(F.col("event_id") % 7 == 0, cut).otherwise(F.col("props")).alias("raw"))


def q02_dead_letters(spark: SparkSession, d: str) -> DataFrame:
    _, dead = decode(_cut_messages(spark, d), "raw", PROPS_SCHEMA, required=["k"], keep=["event_id"])
    return dead


# ------------------------------------------------------------------ row layouts and rules
def q03_account_rows(spark: SparkSession, d: str) -> DataFrame:
    a = jobs.account_rows(fx.fx_account(spark, d))
    return jobs.in_layout(a.select(
        "seq", "account_type", "ccy", "cr_gl", F.col("id").alias("account_no"), "maturity_date",
        F.lit(None).cast("double").alias("rate"), "record_stat", "account_class", F.col("ts").alias("eff_dt"),
        F.lit(None).cast("timestamp_ntz").alias("end_dt"), F.lit(None).cast("timestamp_ntz").alias("update_tms"),
        "act_f"), DIM_ACCOUNT_COLUMNS)


def q04_product_rows(spark: SparkSession, d: str) -> DataFrame:
    p = jobs.product_rows(fx.fx_product(spark, d))
    return p.select(
        "seq", "product_no", *jobs.PRODUCT_ATTRS, F.col("ts").alias("eff_dt"),
        F.lit(None).cast("timestamp_ntz").alias("end_dt"), F.lit(None).cast("timestamp_ntz").alias("update_tms"))


def q05_rate_text(spark: SparkSession, d: str) -> DataFrame:
    a = fx.fx_accr(spark, d)
    r = rate_from_text("cr_int_rate")
    return a.select("account_number", "cr_int_rate", r.cast("double").alias("rate"),
                    (F.col("cr_int_rate").isNotNull() & r.isNull()).alias("bad_rate"))


# ------------------------------------------------------------------ change detection and lookups
def q06_account_changes(spark: SparkSession, d: str) -> DataFrame:
    ch = changed_rows(fx.fx_account(spark, d), [jobs.ACCOUNT_KEY], jobs.ORDER, jobs.ACCOUNT_COMPARE,
                      chunk_rows=chunk_rows_of(spark))
    return drop_scan_columns(ch).select("seq", "id", "prt_code", "ccy", "op_type", "ts")


def q07_account_known(spark: SparkSession, d: str) -> DataFrame:
    a = fx.fx_account(spark, d).select("seq", "id")
    return flag_known(a, ["id"], fx.fx_dim_account(spark, d), ["id"], "known").select("seq", "id", "known")


def q08_account_rate(spark: SparkSession, d: str) -> DataFrame:
    a = fx.fx_account(spark, d).select("seq", "id")
    lk = jobs.account_rate_lookups(fx.fx_az(spark, d), fx.fx_accr(spark, d))
    return priority_lookup(a, "id", lk, "rate").select("seq", "id", F.col("rate").cast("double").alias("rate"))


# ------------------------------------------------------------------ versioned dimensions
def _account_scd2(spark: SparkSession, d: str, close: str) -> DataFrame:
    v = jobs.account_versions(fx.fx_account(spark, d), fx.fx_dim_account(spark, d), fx.fx_az(spark, d),
                              fx.fx_accr(spark, d), close=close, chunk_rows=chunk_rows_of(spark))
    return jobs.account_dimension_layout(v)


def q09_account_scd2(spark: SparkSession, d: str) -> DataFrame:
    return _account_scd2(spark, d, "standard")


def q09r_account_scd2_all_rows(spark: SparkSession, d: str) -> DataFrame:
    return _account_scd2(spark, d, "all_rows")


def q10_product_actions(spark: SparkSession, d: str) -> DataFrame:
    return jobs.product_actions(fx.fx_product(spark, d), fx.fx_dim_product(spark, d), chunk_rows=chunk_rows_of(spark))


def q11_product_history(spark: SparkSession, d: str) -> DataFrame:
    v = jobs.product_versions(fx.fx_product(spark, d), None, chunk_rows=chunk_rows_of(spark))
    return jobs.product_dimension_layout(v)


def q12_product_scd2(spark: SparkSession, d: str) -> DataFrame:
    v = jobs.product_versions(fx.fx_product(spark, d), fx.fx_dim_product(spark, d),
                              chunk_rows=chunk_rows_of(spark))
    return jobs.product_dimension_layout(v)


def q12r_product_scd2_all_rows(spark: SparkSession, d: str) -> DataFrame:
    """As q12, with the source system's close: every row of a changed product except the
    newest carries the newest version's start (stamping needs an open row)."""
    v = jobs.product_versions(fx.fx_product(spark, d), fx.fx_dim_product(spark, d),
                              chunk_rows=chunk_rows_of(spark), close="all_rows")
    return jobs.product_dimension_layout(v)


# ------------------------------------------------------------------ rates
def _rate_inputs(spark: SparkSession, d: str) -> DataFrame:
    """Both rate sources in one schema; rates stay decimal(38,10)."""
    ow = normalise_rate_events(fx.fx_rate_overwrite(spark, d), key="account", rate="amount", source=OVERWRITE,
                               order=["seq"])
    fl = normalise_rate_events(fx.fx_rate_fill(spark, d), key="account", rate="amount", source=FILL, order=["seq"])
    return rate_events(ow, fl)


def q13_rate_inputs(spark: SparkSession, d: str) -> DataFrame:
    return _rate_inputs(spark, d).withColumn("rate", F.col("rate").cast("double"))


def q14_rates_before(spark: SparkSession, d: str) -> DataFrame:
    ev = _rate_inputs(spark, d)
    r = rates_before(ev, fx.fx_rate_dim(spark, d), key="account_no", order=["seq"], dim_key="account_no",
                     dim_rate="rate", chunk_rows=chunk_rows_of(spark))
    return r.select("seq", "account_no", "source", F.col("rate").cast("double").alias("rate"),
                    F.col("rate_before").cast("double").alias("rate_before"))


def q15_rates_final(spark: SparkSession, d: str) -> DataFrame:
    r = rates_final(_rate_inputs(spark, d), fx.fx_rate_dim(spark, d), key="account_no", order=["seq"],
                    dim_key="account_no", dim_rate="rate")
    return r.select("account_no", F.col("rate").cast("double").alias("rate"))


# ------------------------------------------------------------------ keys, facts, messages
def q16_product_keys(spark: SparkSession, d: str) -> DataFrame:
    new = q12_product_scd2(spark, d).filter(F.col("is_new")).select("product_no", "eff_seq")
    return assign_surrogate_keys(new, "product_no", ["eff_seq"], out="pd_dim_id", start=SURROGATE_START,
                                 buckets=SURROGATE_BUCKETS, chunk_rows=chunk_rows_of(spark))


def q17_fact_rows(spark: SparkSession, d: str) -> DataFrame:
    facts = teller_to_fact(fx.fx_teller(spark, d), fx.fx_customer_dim(spark, d), dim_key="c_custkey",
                           dim_id="cst_dim_id", load_date=fx.FACT_LOAD_DATE)
    return jobs.in_layout(facts, FACT_TRANSACTION_COLUMNS)


def q18_messages(spark: SparkSession, d: str) -> DataFrame:
    p = fx.fx_product(spark, d)
    return messages(p, "product_no", "seq", "product_no", "loc_term", "op_type", "category", "sub_product")


ACCOUNT_REQUIRED = ["id", "prtCode", "opType"]


def q19_account_messages(spark: SparkSession, d: str) -> DataFrame:
    """Account messages in the entity layout -> decode (dead letters split off) ->
    dimension rows (PRJ-1: currency->ccy, id->account_no, dateMaturity->maturity_date,
    allInOneProduct->account_class)."""
    msgs = fx.fx_account_messages(spark, d)
    good, _ = decode(msgs, message_text(msgs), ACCOUNT_EVENT, required=ACCOUNT_REQUIRED, keep=["key"])
    ev = jobs.account_events_from_messages(good)
    return jobs.account_rows(ev).select(
        F.col("key").cast("bigint").alias("seq"), F.col("id").alias("account_no"), "account_type", "ccy", "cr_gl",
        "maturity_date", "record_stat", "account_class")


def q20_account_dimension_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rate events on the versioned account dimension: the open version takes the rate."""
    r = jobs.account_rates(fx.fx_dim_account(spark, d), _rate_inputs(spark, d))
    return r.select(F.col("id").alias("account_no"), "eff_seq", "end_seq", F.col("rate").cast("double").alias("rate"))


def q26_rated_account_scd2(spark: SparkSession, d: str) -> DataFrame:
    """Account events and rate events together on the account dimension: each rate event acts on
    the version in force when it comes."""
    v = jobs.rated_account_versions(fx.fx_account(spark, d), fx.fx_dim_account(spark, d), fx.fx_az(spark, d), fx.fx_accr(spark, d),
                                    _rate_inputs(spark, d), chunk_rows=chunk_rows_of(spark))
    return jobs.account_dimension_layout(v)


def q27_fact_point_in_time(spark: SparkSession, d: str) -> DataFrame:
    """Fact rows with the key of the customer's version in force on the transaction's date."""
    return teller_to_fact_at(fx.fx_teller(spark, d), fx.fx_customer_versions(spark, d), dim_key="c_custkey", dim_id="cst_dim_id",
                             begins="eff_dt", ends="end_dt", load_date=fx.FACT_LOAD_DATE, missing=MISSING_MEMBER,
                             chunk_rows=chunk_rows_of(spark))


def _as_message(df: DataFrame, key: str, schema: T.StructType, **fields: Column) -> DataFrame:
    """Rows -> messages in an entity's JSON layout."""
    body = F.struct(*[fields[f.name].alias(f.name) for f in schema.fields if f.name in fields])
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def q21_product_messages(spark: SparkSession, d: str) -> DataFrame:
    """Product messages decoded by their schema into dimension rows."""
    p = fx.fx_product(spark, d)
    m = _as_message(p, "seq", PRODUCT_EVENT, productNo=F.col("product_no"), locTerm=F.col("loc_term"), category=F.col("category"),
                    subProduct=F.col("sub_product"), opType=F.col("op_type"))
    good, _ = decode(m, message_text(m), PRODUCT_EVENT, required=["productNo"], keep=["key"])
    rows = good.select(F.col("key").cast("bigint").alias("seq"), F.lit(None).cast("timestamp_ntz").alias("ts"),
                       F.col("productNo").alias("product_no"), F.col("locTerm").alias("loc_term"), "category",
                       F.col("subProduct").alias("sub_product"), F.col("opType").alias("op_type"))
    return jobs.product_rows(rows).select("seq", "product_no", *jobs.PRODUCT_ATTRS)


def q22_rate_messages(spark: SparkSession, d: str) -> DataFrame:
    """Both rate sources decoded by their schemas, then normalised and unioned."""
    ow, fl = fx.fx_rate_overwrite(spark, d), fx.fx_rate_fill(spark, d)
    amount, name = F.col("amount").cast(T.DecimalType(38, 10)), F.col("account").cast("string")
    a = _as_message(ow, "seq", RATE_OVERWRITE_EVENT, id=name, interestNumber=amount)
    b = _as_message(fl, "seq", RATE_FILL_EVENT, accountNumber=name, crIntRate=amount)
    a, _ = decode(a, message_text(a), RATE_OVERWRITE_EVENT, required=["id"], keep=["key"])
    b, _ = decode(b, message_text(b), RATE_FILL_EVENT, required=["accountNumber"], keep=["key"])
    a, b = (x.withColumn("seq", F.col("key").cast("bigint")) for x in (a, b))
    r = rate_events(normalise_rate_events(a, key="id", rate="interestNumber", source=OVERWRITE, order=["seq"]),
                    normalise_rate_events(b, key="accountNumber", rate="crIntRate", source=FILL, order=["seq"]))
    return r.select("seq", F.col("account_no").cast("bigint").alias("account_no"), F.col("rate").cast("double").alias("rate"), "source")


def q23_teller_messages(spark: SparkSession, d: str) -> DataFrame:
    """Teller messages decoded by their schema, then the fact rows of q17."""
    t = fx.fx_teller(spark, d)
    m = _as_message(t, "id", TELLER_EVENT, **{f.name: F.col(f.name).cast(f.dataType) for f in TELLER_EVENT.fields})
    good, _ = decode(m, message_text(m), TELLER_EVENT, required=["id"])
    good = good.withColumns({"valueDate2": F.col("valueDate2").cast("int"), "customer2": F.col("customer2").cast("bigint"),
                             "amountFcy1": F.col("amountFcy1").cast("double"), "amountFcy2": F.col("amountFcy2").cast("double"),
                             "rate2": F.col("rate2").cast("double")})
    return teller_to_fact(good, fx.fx_customer_dim(spark, d), dim_key="c_custkey", dim_id="cst_dim_id",
                          load_date=fx.FACT_LOAD_DATE)


def q25_product_layout(spark: SparkSession, d: str) -> DataFrame:
    """The product dimension in the warehouse's columns: new versions take the next keys of the
    sequence, the rows that were there have theirs elsewhere (null here)."""
    v = jobs.product_versions(fx.fx_product(spark, d), fx.fx_dim_product(spark, d), chunk_rows=chunk_rows_of(spark))
    v = v.select("*", F.col("eff_ts").alias("eff_dt"), F.col("end_ts").alias("end_dt"),
                 F.when(F.col(TOUCHED), F.col("end_ts")).alias("update_tms")).drop("eff_ts", "end_ts", TOUCHED)
    keyed = assign_surrogate_keys(v.filter(F.col(IS_NEW)), "product_no", ["eff_seq"], out="pd_dim_id", start=SURROGATE_START,
                                  buckets=SURROGATE_BUCKETS, chunk_rows=chunk_rows_of(spark))
    rest = v.filter(~F.col(IS_NEW)).withColumn("pd_dim_id", F.lit(None).cast("bigint"))
    return jobs.in_layout(keyed.unionByName(rest), DIM_PRODUCT_COLUMNS)


def q24_dead_letter_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Every reason: no text, malformed text, a required field missing."""
    e = driver_table(spark, d, "events")
    raw = (F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("string"))
           .when(F.col("event_id") % 7 == 0, F.expr("substring(props, 1, length(props) - 1)"))
           .when(F.col("event_id") % 5 == 0, F.lit("{}")).otherwise(F.col("props")))
    _, dead = decode(e.select("event_id", raw.alias("raw")), "raw", PROPS_SCHEMA, required=["k"], keep=["event_id"])
    return dead


QUERIES: dict[str, Query] = {
    "q01_decode_messages": q01_decode_messages,
    "q02_dead_letters": q02_dead_letters,
    "q03_account_rows": q03_account_rows,
    "q04_product_rows": q04_product_rows,
    "q05_rate_text": q05_rate_text,
    "q06_account_changes": q06_account_changes,
    "q07_account_known": q07_account_known,
    "q08_account_rate": q08_account_rate,
    "q09_account_scd2": q09_account_scd2,
    "q09r_account_scd2_all_rows": q09r_account_scd2_all_rows,
    "q10_product_actions": q10_product_actions,
    "q11_product_history": q11_product_history,
    "q12_product_scd2": q12_product_scd2,
    "q12r_product_scd2_all_rows": q12r_product_scd2_all_rows,
    "q13_rate_inputs": q13_rate_inputs,
    "q14_rates_before": q14_rates_before,
    "q15_rates_final": q15_rates_final,
    "q16_product_keys": q16_product_keys,
    "q17_fact_rows": q17_fact_rows,
    "q18_messages": q18_messages,
    "q19_account_messages": q19_account_messages,
    "q20_account_dimension_rates": q20_account_dimension_rates,
    "q21_product_messages": q21_product_messages,
    "q22_rate_messages": q22_rate_messages,
    "q23_teller_messages": q23_teller_messages,
    "q24_dead_letter_reasons": q24_dead_letter_reasons,
    "q25_product_layout": q25_product_layout,
    "q26_rated_account_scd2": q26_rated_account_scd2,
    "q27_fact_point_in_time": q27_fact_point_in_time,
}


# ====================================================================== oracle SQL
def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ACCOUNT_TYPE_SQL = """CASE WHEN prt_code IS NULL THEN NULL
    WHEN prt_code IN ('32', '47', '49', '51', '56') THEN 'Y'
    WHEN prt_code IN ('21', '31', '33') THEN 'S'
    WHEN prt_code IN ('35', '36') THEN 'N' ELSE 'U' END"""
TERM_BUCKET_SQL = """CASE WHEN loc_term IS NULL THEN NULL
    WHEN ends_with(loc_term, 'D') THEN loc_term
    WHEN NOT regexp_full_match(loc_term, '[+-]?[0-9]+') OR TRY_CAST(loc_term AS INTEGER) IS NULL THEN 'UNKNOWN'
    WHEN TRY_CAST(loc_term AS INTEGER) <= 12 THEN 'SHORTTERM'
    WHEN TRY_CAST(loc_term AS INTEGER) <= 60 THEN 'MEDIUMTERM' ELSE 'LONGTERM' END"""
RATE_TEXT_SQL = "TRY_CAST(trim(regexp_replace({v}, '^.*#', '')) AS DECIMAL(38,10))"

# compared: every field of the event
ACCOUNT_CHANGES_CTE = f"""acc_row AS (
  SELECT *, row({', '.join(jobs.ACCOUNT_COMPARE)}) AS fields FROM fx_account),
acc_lag AS (
  SELECT *, row_number() OVER w AS rn, lag(fields) OVER w AS before
  FROM acc_row WINDOW w AS (PARTITION BY id ORDER BY seq)),
acc_changes AS (
  SELECT seq, id, prt_code, ccy, op_type, ts, maturity_date, account_class FROM acc_lag
  WHERE rn = 1 OR before IS DISTINCT FROM fields)"""

ACCOUNT_NEW_CTE = f"""acc_new AS (
  SELECT c.id, {ACCOUNT_TYPE_SQL} AS account_type, c.ccy, '1' AS cr_gl,
    CASE WHEN az.id IS NOT NULL THEN CAST(az.interest_rate AS DECIMAL(38,10))
         WHEN ac.account_number IS NOT NULL THEN {RATE_TEXT_SQL.format(v='ac.cr_int_rate')} END AS rate,
    CASE WHEN c.op_type = 'D' THEN 'C' ELSE 'O' END AS record_stat, c.maturity_date, c.account_class,
    CAST(NULL AS DECIMAL(38,10)) AS act_f, c.seq AS eff_seq, c.ts AS eff_ts
  FROM acc_changes c LEFT JOIN fx_az az ON az.id = c.id LEFT JOIN fx_accr ac ON ac.account_number = c.id)"""

PRODUCT_ROWS_CTE = f"""prod_rows AS (
  SELECT product_no, seq, ts, {TERM_BUCKET_SQL} AS product_category, category AS product_code,
    sub_product AS product_type, CASE WHEN op_type = 'D' THEN 'D' ELSE 'A' END AS record_stat
  FROM fx_product)"""


def _product_versions_sql(seeded: bool) -> str:
    seed_rows = """
  UNION ALL
  SELECT product_no, eff_seq, eff_ts, product_category, product_code, product_type, record_stat, TRUE
  FROM fx_dim_product WHERE end_seq IS NULL""" if seeded else ""
    closed = """
UNION ALL
SELECT product_no, product_category, product_code, product_type, record_stat, eff_seq, end_seq,
  eff_ts AS eff_dt, end_ts AS end_dt, CAST(NULL AS TIMESTAMP) AS update_tms, FALSE AS is_new
FROM fx_dim_product WHERE end_seq IS NOT NULL""" if seeded else ""
    ctes = [fx.FX_PRODUCT_SQL] + ([fx.FX_DIM_PRODUCT_SQL] if seeded else []) + [PRODUCT_ROWS_CTE, f"""p_all AS (
  SELECT product_no, seq, ts, product_category, product_code, product_type, record_stat, FALSE AS seed
  FROM prod_rows{seed_rows})""", """p_lag AS (
  SELECT *, row_number() OVER w AS rn, lag(product_category) OVER w AS p1, lag(product_code) OVER w AS p2,
    lag(product_type) OVER w AS p3, lag(record_stat) OVER w AS p4
  FROM p_all WINDOW w AS (PARTITION BY product_no ORDER BY seq))""", """p_kept AS (
  SELECT * FROM p_lag WHERE rn = 1 OR p1 IS DISTINCT FROM product_category OR p2 IS DISTINCT FROM product_code
    OR p3 IS DISTINCT FROM product_type OR p4 IS DISTINCT FROM record_stat)""", """p_ver AS (
  SELECT *, lead(seq) OVER w AS end_seq, lead(ts) OVER w AS end_ts
  FROM p_kept WINDOW w AS (PARTITION BY product_no ORDER BY seq))"""]
    return _with(*ctes) + """SELECT product_no, product_category, product_code, product_type, record_stat,
  seq AS eff_seq, end_seq, ts AS eff_dt, end_ts AS end_dt,
  CASE WHEN end_seq IS NOT NULL THEN end_ts END AS update_tms, NOT seed AS is_new
FROM p_ver""" + closed


def _product_all_rows_sql() -> str:
    base = _product_versions_sql(seeded=True)
    # reuse the change-detection CTEs of the standard form, then re-stamp
    ctes = base[:base.index("SELECT product_no, product_category, product_code, product_type, record_stat,\n  seq AS eff_seq")]
    return ctes.rstrip() + """,
p_rows AS (
  SELECT product_no, product_category, product_code, product_type, record_stat, seq AS eff_seq, ts AS eff_ts,
    CAST(NULL AS BIGINT) AS end_seq, CAST(NULL AS TIMESTAMP) AS end_ts, NOT seed AS is_new FROM p_kept
  UNION ALL
  SELECT product_no, product_category, product_code, product_type, record_stat, eff_seq, eff_ts, end_seq, end_ts, FALSE
  FROM fx_dim_product WHERE end_seq IS NOT NULL),
p_info AS (
  SELECT product_no, max(eff_seq) FILTER (WHERE is_new) AS newest_seq,
    arg_max(eff_ts, eff_seq) FILTER (WHERE is_new) AS newest_ts,
    count(*) FILTER (WHERE is_new) AS n_new, bool_or(NOT is_new AND end_seq IS NULL) AS existed
  FROM p_rows GROUP BY product_no),
p_x AS (
  SELECT r.*, i.newest_seq, i.newest_ts,
    (i.n_new >= 1 AND (i.n_new >= 2 OR i.existed) AND NOT (r.is_new AND r.eff_seq = i.newest_seq)) AS stamp
  FROM p_rows r JOIN p_info i ON i.product_no = r.product_no)
SELECT product_no, product_category, product_code, product_type, record_stat, eff_seq,
  CASE WHEN stamp THEN newest_seq ELSE end_seq END AS end_seq, eff_ts AS eff_dt,
  CASE WHEN stamp THEN newest_ts ELSE end_ts END AS end_dt,
  CASE WHEN stamp THEN newest_ts END AS update_tms, is_new
FROM p_x"""


def _account_scd2_sql(close: str) -> str:
    base = [fx.FX_ACCOUNT_SQL, fx.FX_DIM_ACCOUNT_SQL, fx.FX_AZ_SQL, fx.FX_ACCR_SQL, ACCOUNT_CHANGES_CTE,
            ACCOUNT_NEW_CTE]
    if close == "standard":
        return _with(*base, """a_open AS (
  SELECT id, account_type, ccy, cr_gl, rate, record_stat, maturity_date, account_class, act_f, eff_seq, eff_ts, TRUE AS is_new FROM acc_new
  UNION ALL
  SELECT id, account_type, ccy, cr_gl, rate, record_stat, maturity_date, account_class, act_f, eff_seq, eff_ts, FALSE FROM fx_dim_account
  WHERE end_seq IS NULL)""", """a_ver AS (
  SELECT *, lead(eff_seq) OVER w AS end_seq, lead(eff_ts) OVER w AS end_ts
  FROM a_open WINDOW w AS (PARTITION BY id ORDER BY eff_seq))""") + """SELECT id AS account_no, account_type, ccy,
  cr_gl, CAST(rate AS DOUBLE) AS rate, record_stat, maturity_date, account_class, CAST(act_f AS DOUBLE) AS act_f,
  eff_seq, end_seq, eff_ts AS eff_dt, end_ts AS end_dt,
  CASE WHEN end_seq IS NOT NULL THEN end_ts END AS update_tms, is_new
FROM a_ver
UNION ALL
SELECT id, account_type, ccy, cr_gl, CAST(rate AS DOUBLE), record_stat, maturity_date, account_class,
  CAST(act_f AS DOUBLE), eff_seq, end_seq, eff_ts, end_ts,
  CAST(NULL AS TIMESTAMP), FALSE
FROM fx_dim_account WHERE end_seq IS NOT NULL"""
    return _with(*base, """a_all AS (
  SELECT id, account_type, ccy, cr_gl, rate, record_stat, maturity_date, account_class, act_f, eff_seq, eff_ts,
    CAST(NULL AS BIGINT) AS end_seq, CAST(NULL AS TIMESTAMP) AS end_ts, TRUE AS is_new FROM acc_new
  UNION ALL
  SELECT id, account_type, ccy, cr_gl, rate, record_stat, maturity_date, account_class, act_f, eff_seq, eff_ts,
    end_seq, end_ts, FALSE
  FROM fx_dim_account)""", """a_info AS (
  SELECT id, max(eff_seq) FILTER (WHERE is_new) AS newest_seq,
    arg_max(eff_ts, eff_seq) FILTER (WHERE is_new) AS newest_ts,
    count(*) FILTER (WHERE is_new) AS n_new, bool_or(NOT is_new) AS existed
  FROM a_all GROUP BY id)""", """a_x AS (
  SELECT a.*, i.newest_seq, i.newest_ts,
    (i.n_new >= 1 AND (i.n_new >= 2 OR i.existed) AND NOT (a.is_new AND a.eff_seq = i.newest_seq)) AS stamp
  FROM a_all a JOIN a_info i ON i.id = a.id)""") + """SELECT id AS account_no, account_type, ccy, cr_gl,
  CAST(rate AS DOUBLE) AS rate, record_stat, maturity_date, account_class, CAST(act_f AS DOUBLE) AS act_f, eff_seq,
  CASE WHEN stamp THEN newest_seq ELSE end_seq END AS end_seq, eff_ts AS eff_dt,
  CASE WHEN stamp THEN newest_ts ELSE end_ts END AS end_dt,
  CASE WHEN stamp THEN newest_ts END AS update_tms, is_new
FROM a_x"""


RATE_EVENTS = [fx.FX_RATE_EVENTS_SQL, fx.FX_RATE_DIM_SQL]

ORACLE_SQL: dict[str, str] = {
    "q01_decode_messages": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "q02_dead_letters": """WITH m AS (
  SELECT event_id, CASE WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS raw
  FROM events)
SELECT event_id, raw AS raw_value, 'malformed' AS reason FROM m WHERE NOT json_valid(raw)""",
    "q03_account_rows": _with(fx.FX_ACCOUNT_SQL) + f"""SELECT seq, {ACCOUNT_TYPE_SQL} AS account_type, ccy,
  '1' AS cr_gl, id AS account_no, maturity_date, CAST(NULL AS DOUBLE) AS rate,
  CASE WHEN op_type = 'D' THEN 'C' ELSE 'O' END AS record_stat, account_class,
  ts AS eff_dt, CAST(NULL AS TIMESTAMP) AS end_dt, CAST(NULL AS TIMESTAMP) AS update_tms,
  CAST(NULL AS DOUBLE) AS act_f
FROM fx_account""",
    "q04_product_rows": _with(fx.FX_PRODUCT_SQL, PRODUCT_ROWS_CTE) + """SELECT seq, product_no, product_category,
  product_code, product_type, record_stat, ts AS eff_dt, CAST(NULL AS TIMESTAMP) AS end_dt,
  CAST(NULL AS TIMESTAMP) AS update_tms
FROM prod_rows""",
    "q05_rate_text": _with(fx.FX_ACCR_SQL) + f"""SELECT account_number, cr_int_rate,
  CAST({RATE_TEXT_SQL.format(v='cr_int_rate')} AS DOUBLE) AS rate,
  (cr_int_rate IS NOT NULL AND {RATE_TEXT_SQL.format(v='cr_int_rate')} IS NULL) AS bad_rate
FROM fx_accr""",
    "q06_account_changes": _with(fx.FX_ACCOUNT_SQL, ACCOUNT_CHANGES_CTE) + "SELECT seq, id, prt_code, ccy, op_type, ts FROM acc_changes",
    "q07_account_known": _with(fx.FX_ACCOUNT_SQL, fx.FX_DIM_ACCOUNT_SQL) + """SELECT a.seq, a.id,
  EXISTS (SELECT 1 FROM fx_dim_account d WHERE d.id = a.id) AS known
FROM fx_account a""",
    "q08_account_rate": _with(fx.FX_ACCOUNT_SQL, fx.FX_AZ_SQL, fx.FX_ACCR_SQL) + f"""SELECT a.seq, a.id,
  CAST(CASE WHEN az.id IS NOT NULL THEN CAST(az.interest_rate AS DECIMAL(38,10))
            WHEN ac.account_number IS NOT NULL THEN {RATE_TEXT_SQL.format(v='ac.cr_int_rate')} END AS DOUBLE) AS rate
FROM fx_account a LEFT JOIN fx_az az ON az.id = a.id LEFT JOIN fx_accr ac ON ac.account_number = a.id""",
    "q09_account_scd2": _account_scd2_sql("standard"),
    "q09r_account_scd2_all_rows": _account_scd2_sql("all_rows"),
    "q10_product_actions": _with(fx.FX_PRODUCT_SQL, fx.FX_DIM_PRODUCT_SQL, PRODUCT_ROWS_CTE, """p_all AS (
  SELECT product_no, seq, product_category, product_code, product_type, record_stat FROM prod_rows
  UNION ALL
  SELECT product_no, NULL, product_category, product_code, product_type, record_stat FROM fx_dim_product
  WHERE end_seq IS NULL)""",
                                 """p_lag AS (
  SELECT *, lag(row(product_category, product_code, product_type, record_stat)) OVER w AS cur,
    row_number() OVER w AS rn FROM p_all WINDOW w AS (PARTITION BY product_no ORDER BY seq NULLS FIRST))""") + """SELECT
  product_no, seq, CASE WHEN rn = 1 THEN 'INSERT'
    WHEN cur IS NOT DISTINCT FROM row(product_category, product_code, product_type, record_stat) THEN 'NONE'
    ELSE 'REPLACE' END AS action
FROM p_lag WHERE seq IS NOT NULL""",
    "q11_product_history": _product_versions_sql(seeded=False),
    "q12_product_scd2": _product_versions_sql(seeded=True),
    "q12r_product_scd2_all_rows": _product_all_rows_sql(),
    "q13_rate_inputs": _with(fx.FX_RATE_EVENTS_SQL) + """SELECT seq, account_no, CAST(rate AS DOUBLE) AS rate, source
FROM fx_rate_events""",
    "q14_rates_before": _with(*RATE_EVENTS, """x AS (
  SELECT e.*, d.rate AS dim_rate FROM fx_rate_events e JOIN fx_rate_dim d ON d.account_no = e.account_no)""")
    + """SELECT seq, account_no, source, CAST(rate AS DOUBLE) AS rate,
  CAST(coalesce(
    last_value(CASE WHEN source = 'overwrite' THEN rate END IGNORE NULLS) OVER w,
    dim_rate,
    first_value(CASE WHEN source = 'fill' THEN rate END IGNORE NULLS) OVER w) AS DOUBLE) AS rate_before
FROM x WINDOW w AS (PARTITION BY account_no ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "q15_rates_final": _with(*RATE_EVENTS, """agg AS (
  SELECT account_no,
    arg_max(rate, seq) FILTER (WHERE source = 'overwrite' AND rate IS NOT NULL) AS ow,
    arg_min(rate, seq) FILTER (WHERE source = 'fill' AND rate IS NOT NULL) AS fl
  FROM fx_rate_events GROUP BY account_no)""") + """SELECT d.account_no,
  CAST(coalesce(a.ow, d.rate, a.fl) AS DOUBLE) AS rate
FROM fx_rate_dim d LEFT JOIN agg a ON a.account_no = d.account_no""",
    "q16_product_keys": "WITH v AS (\n" + _product_versions_sql(seeded=True) + f"""
)
SELECT CAST(row_number() OVER (ORDER BY product_no % {SURROGATE_BUCKETS}, product_no, eff_seq)
    + {SURROGATE_START - 1} AS BIGINT) AS pd_dim_id, product_no, eff_seq
FROM v WHERE is_new""",
    "q17_fact_rows": """WITH t AS (
  SELECT CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS vd,
    o_custkey, o_orderkey, o_totalprice, o_orderstatus, o_orderpriority,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(1.25 AS DOUBLE) END AS rate2
  FROM orders),
cd AS (SELECT c_custkey, c_custkey + 100000 AS cst_dim_id FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')
SELECT CASE WHEN o_custkey % 2 = 0 THEN 'USD' ELSE 'VND' END AS txn_ccy,
  o_orderpriority AS product_code, CAST(o_orderkey AS VARCHAR) AS trn_ref_no,
  CAST(CAST(CAST(o_totalprice AS DECIMAL(38,10)) * CAST(coalesce(rate2, 1) AS DECIMAL(38,10))
    AS DECIMAL(18,6)) AS DOUBLE) AS lcy_amount,
  o_totalprice AS txn_amount,
  cd.cst_dim_id, o_orderstatus AS record_stat,
  CASE WHEN o_orderstatus = 'F' THEN 'A' ELSE 'U' END AS auth_stat,
  'ACC' || CAST(o_custkey AS VARCHAR) AS txn_acc, 'OFS' || CAST(o_orderkey % 7 AS VARCHAR) AS ofs_acc,
  CAST(try_strptime(CAST(vd AS VARCHAR), '%Y%m%d') AS DATE) AS trn_dt, DATE '2024-06-30' AS etl_date
FROM t LEFT JOIN cd ON cd.c_custkey = t.o_custkey""",
    "q19_account_messages": f"""WITH fx_account AS (SELECT event_id AS seq, ts, user_id AS id, event_type,
    CASE event_type WHEN 'click' THEN '32' WHEN 'purchase' THEN '31'
         WHEN 'view' THEN '35' WHEN 'signup' THEN '21' ELSE '99' END AS prt_code
  FROM events)
SELECT seq, CAST(id AS VARCHAR) AS account_no, {ACCOUNT_TYPE_SQL} AS account_type,
  CASE WHEN seq % 3 = 0 THEN 'USD' ELSE 'VND' END AS ccy, '1' AS cr_gl, CAST(ts AS DATE) AS maturity_date,
  CASE WHEN event_type = 'error' THEN 'C' ELSE 'O' END AS record_stat,
  'P' || CAST(seq % 4 AS VARCHAR) AS account_class
FROM fx_account WHERE seq % 50 <> 0""",
    "q18_messages": _with(fx.FX_PRODUCT_SQL) + """SELECT CAST(product_no AS VARCHAR) AS key,
  CAST(to_json({'seq': seq, 'product_no': product_no, 'loc_term': loc_term, 'op_type': op_type,
                'category': category, 'sub_product': sub_product}) AS VARCHAR) AS value
FROM fx_product""",
}

ORACLE_SQL |= {
    "q25_product_layout": "WITH v AS (\n" + _product_versions_sql(seeded=True) + f"""
)
SELECT CASE WHEN is_new THEN CAST(row_number() OVER (PARTITION BY is_new ORDER BY product_no % {SURROGATE_BUCKETS},
    product_no, eff_seq) + {SURROGATE_START - 1} AS BIGINT) END AS pd_dim_id, *
FROM v""",
    "q20_account_dimension_rates": _with(fx.FX_RATE_EVENTS_SQL, fx.FX_DIM_ACCOUNT_SQL, """agg AS (
  SELECT account_no,
    arg_max(rate, seq) FILTER (WHERE source = 'overwrite' AND rate IS NOT NULL) AS ow,
    arg_min(rate, seq) FILTER (WHERE source = 'fill' AND rate IS NOT NULL) AS fl
  FROM fx_rate_events GROUP BY account_no)""") + """SELECT d.id AS account_no, d.eff_seq, d.end_seq,
  CAST(CASE WHEN d.end_seq IS NULL THEN coalesce(a.ow, d.rate, a.fl) ELSE d.rate END AS DOUBLE) AS rate
FROM fx_dim_account d LEFT JOIN agg a ON a.account_no = d.id""",
    "q26_rated_account_scd2": _with(fx.FX_RATE_EVENTS_SQL, f"v AS (\n{_account_scd2_sql('standard')})", """hit AS (
  SELECT v.account_no, v.eff_seq,
    arg_max(e.rate, e.seq) FILTER (WHERE source = 'overwrite' AND e.rate IS NOT NULL) AS ow,
    arg_min(e.rate, e.seq) FILTER (WHERE source = 'fill' AND e.rate IS NOT NULL) AS fl
  FROM v JOIN fx_rate_events e ON e.account_no = v.account_no AND e.seq >= v.eff_seq
    AND (v.end_seq IS NULL OR e.seq < v.end_seq)
  GROUP BY v.account_no, v.eff_seq)""") + """SELECT
  v.* REPLACE (coalesce(CAST(hit.ow AS DOUBLE), v.rate, CAST(hit.fl AS DOUBLE)) AS rate)
FROM v LEFT JOIN hit ON hit.account_no = v.account_no AND hit.eff_seq = v.eff_seq""",
    "q21_product_messages": _with(fx.FX_PRODUCT_SQL, PRODUCT_ROWS_CTE) + """SELECT seq, product_no, product_category,
  product_code, product_type, record_stat FROM prod_rows""",
    "q22_rate_messages": ORACLE_SQL["q13_rate_inputs"],
    "q23_teller_messages": ORACLE_SQL["q17_fact_rows"],
    "q24_dead_letter_reasons": """WITH m AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL
    WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1) WHEN event_id % 5 = 0 THEN '{}' ELSE props END AS raw
  FROM events)
SELECT event_id, raw AS raw_value, CASE WHEN raw IS NULL THEN 'null' WHEN raw = '{}' THEN 'missing:k'
  ELSE 'malformed' END AS reason
FROM m WHERE raw IS NULL OR raw = '{}' OR NOT json_valid(raw)""",
}

_FACT_SQL = ORACLE_SQL["q17_fact_rows"]
ORACLE_SQL["q27_fact_point_in_time"] = (
    _FACT_SQL[:_FACT_SQL.index("cd AS (")] + fx.FX_CUSTOMER_VERSIONS_SQL + "\n"
    + _FACT_SQL[_FACT_SQL.index("SELECT CASE WHEN o_custkey"):].replace("cd.cst_dim_id", f"coalesce(cd.cst_dim_id, {MISSING_MEMBER}) AS cst_dim_id")
    .replace("FROM t LEFT JOIN cd ON cd.c_custkey = t.o_custkey", """FROM t LEFT JOIN fx_customer_versions cd ON cd.c_custkey = t.o_custkey
  AND cd.eff_dt <= CAST(try_strptime(CAST(vd AS VARCHAR), '%Y%m%d') AS DATE)
  AND (cd.end_dt IS NULL OR CAST(try_strptime(CAST(vd AS VARCHAR), '%Y%m%d') AS DATE) < cd.end_dt)"""))


def account_messages_sql() -> str:
    """The account dimension from the messages of ``fixtures.account_messages_from``: every 50th
    message is dead, and balance, maturity, class and category are the messages' own."""
    base = _account_scd2_sql("standard")
    own = """fx_account AS (
  SELECT *, 'CUST' || CAST(id AS VARCHAR) AS customer, CAST(floor(value * 100) AS BIGINT) AS open_val_date_bal,
    CAST(real_ts AS DATE) AS maturity_date, CAST(floor(value * 90) AS BIGINT) AS working_balance,
    'P' || CAST(seq % 4 AS VARCHAR) AS account_class, CASE WHEN seq % 2 = 0 THEN '1008' ELSE '1005' END AS category,
    '001' AS co_code
  FROM (SELECT event_id AS seq, ts AS real_ts, value, make_timestamp(event_id * 1000000) AS ts, user_id AS id,
    CASE event_type WHEN 'click' THEN '32' WHEN 'purchase' THEN '31'
         WHEN 'view' THEN '35' WHEN 'signup' THEN '21' ELSE '99' END AS prt_code,
    CASE WHEN event_id % 3 = 0 THEN 'USD' ELSE 'VND' END AS ccy,
    CASE WHEN event_type = 'error' THEN 'D' ELSE 'A' END AS op_type
  FROM events WHERE event_id % 50 <> 0))"""
    return ("SELECT account_no, account_type, ccy, rate, record_stat, account_class, eff_seq, end_seq, is_new FROM (\n"
            + base.replace(fx.FX_ACCOUNT_SQL, own) + ")")
