"""Stand-in inputs built from the given tables, twice: as DataFrame code (for the Spark
queries) and as DuckDB SQL (for the oracle).  Both texts describe the same rows; keep
them side by side when changing either."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.schemas import MONEY, TELLER_EVENT
from dimweave.sources.tables import driver_table

SEED_OPEN_SEQ, SEED_CLOSED_SEQ = -5, -9
SEED_OPEN_TS, SEED_CLOSED_TS = "2023-12-31 00:00:00", "2023-12-30 00:00:00"
RATE_NULL_EVERY = 13
FACT_LOAD_DATE = "2024-06-30"


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _mod(c: str, n: int) -> Column:
    return F.col(c) % F.lit(n)


# ------------------------------------------------------------------ account events
def fx_account(spark: SparkSession, d: str) -> DataFrame:
    return account_events_from(driver_table(spark, d, "events"))


def account_events_from(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """events rows -> account change events (works on batch and streaming frames);
    ``keep`` carries further events columns along."""
    et = F.col("event_type")
    prt = (F.when(et == "click", "32").when(et == "purchase", "31").when(et == "view", "35")
           .when(et == "signup", "21").otherwise("99"))
    return events.select(*keep,
        F.col("event_id").alias("seq"), "ts", F.col("user_id").alias("id"), prt.alias("prt_code"),
        F.when(_mod("event_id", 3) == 0, "USD").otherwise("VND").alias("ccy"),
        F.when(et == "error", "D").otherwise("A").alias("op_type"),
        F.concat(F.lit("CUST"), F.col("user_id").cast("string")).alias("customer"),
        (F.col("user_id").cast("bigint") * 10).alias("open_val_date_bal"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("event_id") % 60 / 30).cast("int")).alias("maturity_date"),
        F.when(et == "purchase", 9007199254740993).otherwise(9007199254740992).cast("bigint").alias("working_balance"),
        F.concat(F.lit("P"), (F.col("user_id") % 4).cast("string")).alias("account_class"),
        F.when(_mod("event_id", 70) == 0, F.lit(None).cast("string")).otherwise("1005").alias("category"),
        F.lit("001").alias("co_code"))


FX_ACCOUNT_SQL = """fx_account AS (
  SELECT event_id AS seq, ts, user_id AS id,
    CASE event_type WHEN 'click' THEN '32' WHEN 'purchase' THEN '31'
         WHEN 'view' THEN '35' WHEN 'signup' THEN '21' ELSE '99' END AS prt_code,
    CASE WHEN event_id % 3 = 0 THEN 'USD' ELSE 'VND' END AS ccy,
    CASE WHEN event_type = 'error' THEN 'D' ELSE 'A' END AS op_type,
    'CUST' || CAST(user_id AS VARCHAR) AS customer, CAST(user_id AS BIGINT) * 10 AS open_val_date_bal,
    DATE '2025-01-01' + CAST(event_id % 60 // 30 AS INTEGER) AS maturity_date,
    CASE WHEN event_type = 'purchase' THEN 9007199254740993 ELSE 9007199254740992 END AS working_balance,
    'P' || CAST(user_id % 4 AS VARCHAR) AS account_class,
    CASE WHEN event_id % 70 = 0 THEN NULL ELSE '1005' END AS category, '001' AS co_code
  FROM events)"""


def fx_account_messages(spark: SparkSession, d: str) -> DataFrame:
    """Account change messages in the entity's own JSON layout (camelCase fields),
    keyed by event id.  The maturity date is epoch millis on even events and ISO text
    on odd ones; every 50th message lacks its product code."""
    return account_messages_from(driver_table(spark, d, "events"))


def account_messages_from(events: DataFrame) -> DataFrame:
    """events rows (batch or streaming) -> account messages."""
    e = account_events_from(events, keep=("value",))
    common = [
        F.col("id").cast("string").alias("id"), F.concat(F.lit("CUST"), F.col("id").cast("string")).alias("customer"),
        F.when(F.col("seq") % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("prt_code")).alias("prtCode"),
        F.col("ccy").alias("currency"), F.floor(F.col("value") * 100).cast("bigint").alias("openValDateBal"),
    ]
    rest = [
        F.col("op_type").alias("opType"), F.floor(F.col("value") * 90).cast("bigint").alias("workingBalance"),
        F.concat(F.lit("P"), (F.col("seq") % 4).cast("string")).alias("allInOneProduct"),
        F.when(F.col("seq") % 2 == 0, "1008").otherwise("1005").alias("category"), F.lit("001").alias("coCode"),
    ]
    millis = F.unix_millis(F.col("ts").cast("timestamp")).alias("dateMaturity")
    text = F.date_format(F.col("ts"), "yyyy-MM-dd").alias("dateMaturity")
    opts = {"ignoreNullFields": "false"}
    value = F.when(F.col("seq") % 2 == 0, F.to_json(F.struct(*common, millis, *rest), opts)).otherwise(
        F.to_json(F.struct(*common, text, *rest), opts))
    return e.select(F.col("seq").cast("string").alias("key"), value.alias("value"))


# ------------------------------------------------------------------ product events
def fx_product(spark: SparkSession, d: str) -> DataFrame:
    return product_events_from(driver_table(spark, d, "events"))


def product_events_from(events: DataFrame) -> DataFrame:
    """events rows -> product change events (batch or streaming frames)."""
    et, eid = F.col("event_type"), F.col("event_id")
    whole = F.floor(F.col("value")).cast("int")
    loc = (F.when(eid % 11 == 0, F.lit(None).cast("string"))
           .when(et == "signup", F.concat((whole % 3).cast("string"), F.lit("D")))
           .when((et == "error") & (eid % 2 == 0), F.lit("n/a"))
           .otherwise(whole.cast("string")))
    return events.select(
        eid.alias("seq"), "ts", F.get_json_object("props", "$.k").cast("int").alias("product_no"),
        loc.alias("loc_term"), F.when(eid % 5 == 0, "D").otherwise("A").alias("op_type"),
        F.concat(F.lit("C"), (eid % 2).cast("string")).alias("category"), F.lit("S1").alias("sub_product"))


FX_PRODUCT_SQL = """fx_product AS (
  SELECT event_id AS seq, ts, CAST(json_extract(props, '$.k') AS INT) AS product_no,
    CASE WHEN event_id % 11 = 0 THEN NULL
         WHEN event_type = 'signup' THEN CAST(CAST(floor(value) AS INT) % 3 AS VARCHAR) || 'D'
         WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'n/a'
         ELSE CAST(CAST(floor(value) AS INT) AS VARCHAR) END AS loc_term,
    CASE WHEN event_id % 5 = 0 THEN 'D' ELSE 'A' END AS op_type,
    'C' || CAST(event_id % 2 AS VARCHAR) AS category, 'S1' AS sub_product
  FROM events)"""


# ------------------------------------------------------------------ the two rate lookups
def fx_az(spark: SparkSession, d: str) -> DataFrame:
    """First rate table: every supplier id; no rate where the balance is negative."""
    s = driver_table(spark, d, "supplier")
    return s.select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_acctbal") < 0, F.lit(None).cast("double")).otherwise(F.col("s_acctbal"))
        .alias("interest_rate"))


FX_AZ_SQL = """fx_az AS (
  SELECT s_suppkey AS id, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS interest_rate
  FROM supplier)"""


def fx_accr(spark: SparkSession, d: str) -> DataFrame:
    """Second rate table, as text: customers outside one market segment; some rates
    carry a ``T#`` prefix, and negative balances have the unparsable text ``T#``."""
    c = driver_table(spark, d, "customer").filter(F.col("c_mktsegment") != "MACHINERY")
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string")
    prefixed = F.col("c_mktsegment").isin("BUILDING", "FURNITURE")
    text = (F.when(F.col("c_acctbal") < 0, F.lit("T#"))
            .when(prefixed, F.concat(F.lit("T#"), cents)).otherwise(cents))
    return c.select(F.col("c_custkey").alias("account_number"), text.alias("cr_int_rate"))


FX_ACCR_SQL = """fx_accr AS (
  SELECT c_custkey AS account_number,
    CASE WHEN c_acctbal < 0 THEN 'T#'
         WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'T#' || cents ELSE cents END AS cr_int_rate
  FROM (SELECT c_custkey, c_mktsegment, c_acctbal,
          CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS cents
        FROM customer WHERE c_mktsegment <> 'MACHINERY'))"""


# ------------------------------------------------------------------ seeded dimensions
def fx_dim_account(spark: SparkSession, d: str) -> DataFrame:
    """Existing account dimension: an open row for customers with a non-negative
    balance, a closed older row for the customers of one market segment."""
    c = driver_table(spark, d, "customer")

    def rows(cond: Column, eff_seq: int, end_seq: int | None, eff_ts: str, end_ts: str | None) -> DataFrame:
        return c.filter(cond).select(
            F.col("c_custkey").alias("id"), F.lit("S").alias("account_type"), F.lit("VND").alias("ccy"),
            F.lit("1").alias("cr_gl"), F.col("c_acctbal").cast("decimal(38,10)").alias("rate"),
            F.lit("O").alias("record_stat"), F.lit(None).cast("date").alias("maturity_date"),
            F.lit(None).cast("string").alias("account_class"), F.lit(None).cast("decimal(38,10)").alias("act_f"),
            F.lit(eff_seq).cast("bigint").alias("eff_seq"), F.lit(end_seq).cast("bigint").alias("end_seq"),
            _ntz(eff_ts).alias("eff_ts"),
            (_ntz(end_ts) if end_ts else F.lit(None).cast("timestamp_ntz")).alias("end_ts"))

    return rows(F.col("c_acctbal") >= 0, SEED_OPEN_SEQ, None, SEED_OPEN_TS, None).unionByName(
        rows(F.col("c_mktsegment") == "AUTOMOBILE", SEED_CLOSED_SEQ, SEED_OPEN_SEQ, SEED_CLOSED_TS, SEED_OPEN_TS))


FX_DIM_ACCOUNT_SQL = """fx_dim_account AS (
  SELECT c_custkey AS id, 'S' AS account_type, 'VND' AS ccy, '1' AS cr_gl,
    CAST(c_acctbal AS DECIMAL(38,10)) AS rate, 'O' AS record_stat, CAST(NULL AS DATE) AS maturity_date,
    CAST(NULL AS VARCHAR) AS account_class, CAST(NULL AS DECIMAL(38,10)) AS act_f,
    CAST(-5 AS BIGINT) AS eff_seq, CAST(NULL AS BIGINT) AS end_seq,
    TIMESTAMP '2023-12-31 00:00:00' AS eff_ts, CAST(NULL AS TIMESTAMP) AS end_ts
  FROM customer WHERE c_acctbal >= 0
  UNION ALL
  SELECT c_custkey, 'S', 'VND', '1', CAST(c_acctbal AS DECIMAL(38,10)), 'O', NULL, NULL, NULL,
    CAST(-9 AS BIGINT), CAST(-5 AS BIGINT),
    TIMESTAMP '2023-12-30 00:00:00', TIMESTAMP '2023-12-31 00:00:00'
  FROM customer WHERE c_mktsegment = 'AUTOMOBILE')"""


def fx_dim_product(spark: SparkSession, d: str) -> DataFrame:
    """Existing product dimension: an open row for the smaller parts."""
    p = driver_table(spark, d, "part").filter(F.col("p_size") <= 25)
    cat = F.when(F.col("p_size") <= 12, "SHORTTERM").when(F.col("p_size") <= 60, "MEDIUMTERM").otherwise("LONGTERM")
    return p.select(
        F.col("p_partkey").cast("int").alias("product_no"), cat.alias("product_category"),
        F.lit("C0").alias("product_code"), F.lit("S1").alias("product_type"), F.lit("A").alias("record_stat"),
        F.lit(SEED_OPEN_SEQ).cast("bigint").alias("eff_seq"), F.lit(None).cast("bigint").alias("end_seq"),
        _ntz(SEED_OPEN_TS).alias("eff_ts"), F.lit(None).cast("timestamp_ntz").alias("end_ts"))


FX_DIM_PRODUCT_SQL = """fx_dim_product AS (
  SELECT CAST(p_partkey AS INT) AS product_no,
    CASE WHEN p_size <= 12 THEN 'SHORTTERM' WHEN p_size <= 60 THEN 'MEDIUMTERM' ELSE 'LONGTERM' END
      AS product_category,
    'C0' AS product_code, 'S1' AS product_type, 'A' AS record_stat,
    CAST(-5 AS BIGINT) AS eff_seq, CAST(NULL AS BIGINT) AS end_seq,
    TIMESTAMP '2023-12-31 00:00:00' AS eff_ts, CAST(NULL AS TIMESTAMP) AS end_ts
  FROM part WHERE p_size <= 25)"""


# ------------------------------------------------------------------ rate events and rate dimension
def fx_rate_overwrite(spark: SparkSession, d: str) -> DataFrame:
    return _rate_source(spark, d, "purchase")


def fx_rate_fill(spark: SparkSession, d: str) -> DataFrame:
    return _rate_source(spark, d, "click")


def _rate_source(spark: SparkSession, d: str, event_type: str) -> DataFrame:
    return rate_source_from(driver_table(spark, d, "events"), event_type)


def rate_source_from(events: DataFrame, event_type: str) -> DataFrame:
    """events rows of one type -> rate events (seq, account, amount)."""
    e = events.filter(F.col("event_type") == event_type)
    return e.select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("account"),
        F.when(_mod("event_id", RATE_NULL_EVERY) == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
        .alias("amount"))


FX_RATE_EVENTS_SQL = """fx_rate_events AS (
  SELECT event_id AS seq, user_id AS account_no,
    CAST(CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS DECIMAL(38,10)) AS rate,
    CASE WHEN event_type = 'purchase' THEN 'overwrite' ELSE 'fill' END AS source
  FROM events WHERE event_type IN ('purchase', 'click'))"""


def fx_rate_dim(spark: SparkSession, d: str) -> DataFrame:
    """Accounts with their current rate: customers outside one market segment (so some
    rate events name unknown accounts); no rate yet where the balance is below 1000."""
    c = driver_table(spark, d, "customer").filter(F.col("c_mktsegment") != "HOUSEHOLD")
    return c.select(F.col("c_custkey").alias("account_no"),
                    F.when(F.col("c_acctbal") < 1000, F.lit(None).cast("double")).otherwise(F.col("c_acctbal"))
                    .alias("rate"))


FX_RATE_DIM_SQL = """fx_rate_dim AS (
  SELECT c_custkey AS account_no,
    CAST(CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_acctbal END AS DECIMAL(38,10)) AS rate
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')"""


# ------------------------------------------------------------------ teller transactions
def fx_teller(spark: SparkSession, d: str) -> DataFrame:
    return teller_from(driver_table(spark, d, "orders"))


def teller_from(o: DataFrame) -> DataFrame:
    """orders rows -> teller transactions (batch or streaming frames)."""
    od = F.col("o_orderdate")
    return o.select(
        (F.year(od) * 10000 + F.month(od) * 100 + F.dayofmonth(od)).alias("valueDate2"),
        F.when(_mod("o_custkey", 2) == 0, "USD").otherwise("VND").alias("currency1"),
        F.col("o_orderpriority").alias("transactionCode"), F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("amountFcy1"), F.lit(None).cast("double").alias("amountFcy2"),
        F.when(_mod("o_orderkey", 4) == 0, F.lit(None).cast("double")).otherwise(F.lit(1.25)).alias("rate2"),
        F.col("o_custkey").alias("customer2"),
        F.when(F.col("o_orderstatus") == "F", "SYSTEM").alias("authoriser"),
        F.col("o_orderstatus").alias("opType"),
        F.concat(F.lit("ACC"), F.col("o_custkey").cast("string")).alias("account1"),
        F.concat(F.lit("OFS"), (F.col("o_orderkey") % 7).cast("string")).alias("account2"))


def fx_customer_dim(spark: SparkSession, d: str) -> DataFrame:
    """Customer dimension keys: one market segment is not loaded yet."""
    c = driver_table(spark, d, "customer").filter(F.col("c_mktsegment") != "HOUSEHOLD")
    return c.select("c_custkey", (F.col("c_custkey") + F.lit(100000)).alias("cst_dim_id"))


def fx_customer_versions(spark: SparkSession, d: str) -> DataFrame:
    """Three versions of every customer in ``fx_customer_dim``, 700 days each, beginning at a day of
    the customer's own; the last is open but for every fifth customer, whose ends after 400 days."""
    c = driver_table(spark, d, "customer").filter(F.col("c_mktsegment") != "HOUSEHOLD")
    c = c.select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i"))
    days = ((F.col("c_custkey") % 200) - 100 + F.col("i") * 700).cast("int")
    first = F.lit("1996-01-01").cast("date")
    end = F.when(F.col("i") < 2, F.date_add(first, days + 700)).when(_mod("c_custkey", 5) == 0, F.date_add(first, days + 400))
    return c.select("c_custkey", (F.col("c_custkey") * 10 + F.col("i") + 100000).alias("cst_dim_id"),
                    F.date_add(first, days).alias("eff_dt"), end.alias("end_dt"))


FX_CUSTOMER_VERSIONS_SQL = """fx_customer_versions AS (
  SELECT c_custkey, c_custkey * 10 + i + 100000 AS cst_dim_id, DATE '1996-01-01' + days AS eff_dt,
    CASE WHEN i < 2 THEN DATE '1996-01-01' + days + 700
         WHEN c_custkey % 5 = 0 THEN DATE '1996-01-01' + days + 400 END AS end_dt
  FROM (SELECT c_custkey, i, CAST(c_custkey % 200 - 100 + i * 700 AS INTEGER) AS days
        FROM customer, range(3) r(i) WHERE c_mktsegment <> 'HOUSEHOLD'))"""


# ------------------------------------------------------------------ messages of every entity
def _with_faults(rows: DataFrame, seq: str, ts: str, **fields: Column) -> DataFrame:
    """Rows -> messages (value, seq, ts); every 50th text is cut short, every 49th is missing."""
    body = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})
    x = rows.select(F.col(seq).alias("seq"), F.col(ts).cast("timestamp_ntz").alias("ts"), body.alias("value"))
    value = (F.when(_mod("seq", 50) == 0, F.expr("substring(value, 1, length(value) - 1)"))
             .when(_mod("seq", 49) == 0, F.lit(None).cast("string")).otherwise(F.col("value")))
    return x.select(value.alias("value"), "seq", "ts")


def _but_47th(c: Column, seq: str, instead: str | None = None) -> Column:
    return F.when(_mod(seq, 47) == 0, F.lit(instead).cast("string")).otherwise(c.cast("string"))


NO_FAULT_SQL = "{0} % 50 <> 0 AND {0} % 49 <> 0 AND {0} % 47 <> 0"


def product_messages_from(events: DataFrame) -> DataFrame:
    """events rows (batch or streaming) -> product messages; every 47th lacks its product."""
    return _with_faults(product_events_from(events), "seq", "ts", productNo=_but_47th(F.col("product_no"), "seq").cast("int"),
                        locTerm=F.col("loc_term"), category=F.col("category"), subProduct=F.col("sub_product"), opType=F.col("op_type"))


def rate_messages_from(events: DataFrame, event_type: str, key: str, rate: str) -> DataFrame:
    """events rows of one type -> rate messages; every 47th account isn't a number."""
    r = rate_source_from(events, event_type).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    return _with_faults(r, "seq", "ts", **{key: _but_47th(F.col("account"), "seq", "n/a"), rate: F.col("amount").cast(MONEY)})


def teller_messages_from(orders: DataFrame) -> DataFrame:
    """orders rows -> teller messages; every 47th lacks its id."""
    t = teller_from(orders).withColumns({"seq": F.col("id"), "ts": F.lit(None).cast("timestamp_ntz")})
    own = {f.name: F.col(f.name).cast(f.dataType) for f in TELLER_EVENT.fields}
    return _with_faults(t, "seq", "ts", **{**own, "id": _but_47th(F.col("id"), "seq")})
