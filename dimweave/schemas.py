"""Declared schemas of the message entities and dimension rows (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(38, 10)

# Account change event.  dateMaturity arrives as text or as epoch millis, so it is
# read as text and typed later (see functions.expressions.flexible_date).
ACCOUNT_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("customer", T.StringType()),
    T.StructField("prtCode", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("openValDateBal", T.LongType()),
    T.StructField("dateMaturity", T.StringType()),
    T.StructField("opType", T.StringType()),
    T.StructField("workingBalance", T.LongType()),
    T.StructField("allInOneProduct", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("coCode", T.StringType()),
])

PRODUCT_EVENT = T.StructType([
    T.StructField("productNo", T.IntegerType()),
    T.StructField("locTerm", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("subProduct", T.StringType()),
    T.StructField("opType", T.StringType()),
])

# Rate events: the "fill" source and the "overwrite" source.
RATE_FILL_EVENT = T.StructType([
    T.StructField("accountNumber", T.StringType()),
    T.StructField("crIntRate", MONEY),
])
RATE_OVERWRITE_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("interestNumber", MONEY),
])

TELLER_EVENT = T.StructType([
    T.StructField("valueDate2", MONEY),
    T.StructField("currency1", T.StringType()),
    T.StructField("transactionCode", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("amountFcy1", MONEY),
    T.StructField("amountFcy2", MONEY),
    T.StructField("rate2", MONEY),
    T.StructField("customer2", T.StringType()),
    T.StructField("authoriser", T.StringType()),
    T.StructField("opType", T.StringType()),
    T.StructField("account1", T.StringType()),
    T.StructField("account2", T.StringType()),
])

# Target row layouts, in the warehouse's column order.
DIM_ACCOUNT_COLUMNS = [
    ("account_type", "string"), ("ccy", "string"), ("cr_gl", "string"),
    ("account_no", None), ("maturity_date", "date"), ("rate", "decimal(38,10)"),
    ("record_stat", "string"), ("account_class", "string"), ("eff_dt", None),
    ("end_dt", None), ("update_tms", None), ("act_f", "decimal(38,10)"),
]

DIM_PRODUCT_COLUMNS = [
    ("pd_dim_id", "bigint"), ("product_no", "int"), ("product_category", "string"),
    ("product_code", "string"), ("product_type", "string"), ("record_stat", "string"),
    ("eff_dt", None), ("end_dt", None), ("update_tms", None),
]

FACT_TRANSACTION_COLUMNS = [
    ("txn_ccy", "string"), ("product_code", "string"), ("trn_ref_no", "string"),
    ("lcy_amount", "double"), ("txn_amount", "double"), ("cst_dim_id", None),
    ("record_stat", "string"), ("auth_stat", "string"), ("txn_acc", "string"),
    ("ofs_acc", "string"), ("trn_dt", "date"), ("etl_date", "date"),
]
