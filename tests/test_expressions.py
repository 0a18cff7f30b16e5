"""Tables of cases for the scalar rules (edge values from the source system's code)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimweave.functions import (
    account_record_stat,
    account_type,
    flexible_date,
    product_record_stat,
    rate_from_text,
    term_bucket,
    to_message,
    yyyymmdd_to_date,
)


def _apply(spark, fn, values, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


ACCOUNT_TYPE_CASES = [
    ("32", "Y"), ("47", "Y"), ("49", "Y"), ("51", "Y"), ("56", "Y"),
    ("21", "S"), ("31", "S"), ("33", "S"), ("35", "N"), ("36", "N"),
    ("321", "U"), (" 32", "U"), ("32\n", "U"), ("", "U"), ("99", "U"), (None, None),
]

TERM_CASES = [
    (None, None), ("30D", "30D"), ("D", "D"), ("12", "SHORTTERM"), ("+12", "SHORTTERM"),
    ("0012", "SHORTTERM"), ("-3", "SHORTTERM"), ("13", "MEDIUMTERM"), ("60", "MEDIUMTERM"),
    ("61", "LONGTERM"), (" 12", "UNKNOWN"), ("12 ", "UNKNOWN"), ("12.0", "UNKNOWN"), ("1e1", "UNKNOWN"),
    ("", "UNKNOWN"), ("12d", "UNKNOWN"), ("99999999999", "UNKNOWN"), ("12\n", "UNKNOWN"),
    ("2147483647", "LONGTERM"), ("2147483648", "UNKNOWN"),
    ("\u0661\u0662", "SHORTTERM"), ("\uff11\uff13", "MEDIUMTERM"), ("-\u0967", "SHORTTERM"), ("\u0661 ", "UNKNOWN"),
]

RATE_CASES = [
    ("3.4", Decimal("3.4")), ("a#3.4", Decimal("3.4")), ("a#b# 3.5 ", Decimal("3.5")), ("#.5", Decimal("0.5")),
    ("1e3", Decimal("1000")), ("x#", None), ("abc", None), ("1,2", None), (None, None),
]


@pytest.mark.parametrize("fn,cases", [(account_type, ACCOUNT_TYPE_CASES), (term_bucket, TERM_CASES)])
def test_code_tables(spark, fn, cases):
    got = _apply(spark, fn, [c for c, _ in cases])
    assert got == [e for _, e in cases]


def test_rate_text(spark):
    got = _apply(spark, rate_from_text, [c for c, _ in RATE_CASES])
    assert got == [e for _, e in RATE_CASES]


def test_record_stats(spark):
    assert _apply(spark, account_record_stat, ["D", "A", "x", "d"]) == ["C", "O", "O", "O"]
    assert _apply(spark, product_record_stat, ["D", "A", "x", "d"]) == ["D", "A", "A", "A"]


def test_dates(spark):
    import datetime as dt

    assert _apply(spark, flexible_date, ["1713139200000", "2024-04-15", "junk", None]) == [
        dt.date(2024, 4, 15), dt.date(2024, 4, 15), None, None]
    assert _apply(spark, yyyymmdd_to_date, [Decimal("20240415"), Decimal("20241341"), None],
                  "decimal(38,10)") == [dt.date(2024, 4, 15), None, None]


def test_message_keeps_null_fields(spark):
    df = spark.createDataFrame([(1, None, "x")], "k int, a string, b string")
    m = df.select(to_message("k", "k", "a", "b").alias("m")).first().m
    assert m.key == "1"
    assert m.value == '{"k":1,"a":null,"b":"x"}'
