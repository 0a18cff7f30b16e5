"""Column -> Column functions (all JVM-side, no UDF)."""

from dimweave.functions.expressions import (  # noqa: F401
    account_record_stat,
    account_type,
    flexible_date,
    product_record_stat,
    rate_from_text,
    strict_int,
    term_bucket,
    to_message,
    yyyymmdd_to_date,
)
