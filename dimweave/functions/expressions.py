"""Scalar rules of the loaders as Column expressions.

All of them stay inside whole-stage codegen: ``when``/``isin``/``rlike``/``try_cast``.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimweave.schemas import MONEY

# ---------------------------------------------------------------------------
# These must equal the source system's rules for right results.
# Account type by whole-string product code:
#   32, 47, 49, 51, 56 -> Y
#   21, 31, 33         -> S
#   35, 36             -> N
#   anything else      -> U
# Term bucket of a product's term: a whole 32-bit integer <= 12 -> SHORTTERM,
#   <= 60 -> MEDIUMTERM, larger -> LONGTERM; text ending in "D" is kept as is;
#   other text -> UNKNOWN; null stays null.
# Record status: account "D" -> C, else O; product "D" -> D, else A.
# Rate text: the part after the last "#", trimmed, as a decimal.
# ---------------------------------------------------------------------------
ACCOUNT_TYPE_CODES = {
    "Y": ["32", "47", "49", "51", "56"],
    "S": ["21", "31", "33"],
    "N": ["35", "36"],
}
ACCOUNT_TYPE_OTHER = "U"
TERM_SHORT_MAX = 12
TERM_MEDIUM_MAX = 60


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def account_type(prt_code: Column | str) -> Column:
    """Whole-string code match; null in, null out (a required field upstream)."""
    c = _c(prt_code)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for label, codes in ACCOUNT_TYPE_CODES.items():
        out = out.when(c.isin(*codes), F.lit(label))
    return out.otherwise(F.lit(ACCOUNT_TYPE_OTHER))


def account_record_stat(op_type: Column | str) -> Column:
    return F.when(_c(op_type) == F.lit("D"), F.lit("C")).otherwise(F.lit("O"))


def product_record_stat(op_type: Column | str) -> Column:
    return F.when(_c(op_type) == F.lit("D"), F.lit("D")).otherwise(F.lit("A"))


@functools.lru_cache(maxsize=1)
def _decimal_digits() -> tuple[str, str]:
    """Every non-ASCII Unicode decimal digit and its ASCII value (built by rule from the
    Unicode database), so that integer parsing reads any script's digits."""
    src, dst = [], []
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.digit(ch)))
    return "".join(src), "".join(dst)


def strict_int(text: Column | str) -> Column:
    """Text -> int only when it is an optionally signed run of decimal digits (any
    script) that fits in 32 bits; anything else (spaces, decimals, exponents, overflow)
    -> null.  ``\\z`` (not ``$``) so that a trailing newline is refused too."""
    c = _c(text)
    src, dst = _decimal_digits()
    return F.when(c.rlike(r"^[+-]?\p{Nd}+\z"), F.translate(c, src, dst).try_cast("int"))


def term_bucket(loc_term: Column | str) -> Column:
    c = _c(loc_term)
    n = strict_int(c)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(c.endswith("D"), c)
        .when(n.isNull(), F.lit("UNKNOWN"))
        .when(n <= TERM_SHORT_MAX, F.lit("SHORTTERM"))
        .when(n <= TERM_MEDIUM_MAX, F.lit("MEDIUMTERM"))
        .otherwise(F.lit("LONGTERM"))
    )


def rate_from_text(text: Column | str) -> Column:
    """Rate held as text such as ``abc#3.4``: the trimmed part after the last ``#``
    (the whole text when there is none) as decimal(38,10); unparsable -> null."""
    c = _c(text)
    return F.trim(F.substring_index(c, "#", -1)).try_cast(MONEY)


def flexible_date(text: Column | str) -> Column:
    """A date that arrives either as epoch millis or as ISO text."""
    c = F.trim(_c(text))
    return (
        F.when(c.rlike(r"^-?[0-9]+\z"), F.to_date(F.timestamp_millis(c.try_cast("bigint"))))
        .otherwise(F.try_to_date(c))
    )


def yyyymmdd_to_date(num: Column | str) -> Column:
    """20240415 held in a number (decimal or int) -> DATE; bad values -> null."""
    return F.try_to_date(_c(num).try_cast("int").cast("string"), "yyyyMMdd")


def to_message(key: Column | str, *fields: str) -> Column:
    """(key, JSON value) message struct; null fields are written as ``null``."""
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return F.struct(_c(key).cast("string").alias("key"), value.alias("value"))
