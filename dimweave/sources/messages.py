"""Message decoding: value-only text -> typed rows, with a dead-letter split.

Every input row goes to exactly one side.  A row is dead when its text is null, is not
a JSON object that matches the schema, lacks a required field, or has a field that can't be
read as the type asked for.  Fields the schema
does not name are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def message_text(df: DataFrame, value: str = "value") -> Column:
    """Value-only decode: the message key is ignored, the value read as UTF-8 text."""
    return F.col(value).cast("string")


def decode(df: DataFrame, text: Column | str, schema: T.StructType, *, required: Sequence[str] = (),
           keep: Sequence[str] = (), typed: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Return ``(good, dead)``.

    good: ``keep`` columns + the schema's fields.  dead: ``keep`` columns, ``raw_value``
    and ``reason`` (``null``, ``malformed``, ``missing:<field>`` or ``unreadable:<field>``).
    ``typed``: fields to return in another type than the schema's, such as a text that must be a
    whole number; a value that can't be read so makes the row dead.
    """
    typed = dict(typed or {})
    raw = F.col(text) if isinstance(text, str) else text
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(raw, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # Parsed once per message: a one-element generator keeps Catalyst from inlining the
    # parse into every field reference and into the split's filters below it.
    x = df.select(*keep, raw.alias("raw_value"), F.explode(F.array(parsed)).alias("_dw_msg"))
    reason = (
        F.when(F.col("raw_value").isNull(), F.lit("null"))
        .when(F.col("_dw_msg").isNull() | F.col(f"_dw_msg.{CORRUPT}").isNotNull(), F.lit("malformed"))
    )
    for f in required:
        reason = reason.when(F.col(f"_dw_msg.{f}").isNull(), F.lit(f"missing:{f}"))
    fields = {f.name: F.col(f"_dw_msg.{f.name}") for f in schema.fields}
    for f, kind in typed.items():
        read = fields[f].try_cast(kind)
        reason = reason.when(fields[f].isNotNull() & read.isNull(), F.lit(f"unreadable:{f}"))
        fields[f] = read
    x = x.withColumn("reason", reason)
    good = x.filter(F.col("reason").isNull()).select(*keep, *[c.alias(f) for f, c in fields.items()])
    dead = x.filter(F.col("reason").isNotNull()).select(*keep, "raw_value", "reason")
    return good, dead
