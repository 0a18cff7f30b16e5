"""Bad input: every message lands on exactly one side; reasons are stated."""

from pyspark.sql import types as T

from dimweave.schemas import PRODUCT_EVENT
from dimweave.sources.messages import decode

MESSAGES = [
    (1, '{"productNo": 7, "locTerm": "12", "category": "C", "subProduct": "S", "opType": "A"}'),
    (2, '{"productNo": 7, "locTerm": "12", "extra": 1}'),  # unknown field: ignored
    (3, '{"productNo": "seven"}'),  # wrong type
    (4, "[]"),
    (5, ""),
    (6, "null"),
    (7, None),
    (8, "not json"),
    (9, '{"productno": 7}'),  # other letter case: not the field -> missing
    (10, '{"productNo": 8'),  # cut short
]


def test_every_row_on_one_side(spark):
    df = spark.createDataFrame(MESSAGES, "id int, value string")
    good, dead = decode(df, "value", PRODUCT_EVENT, required=["productNo"], keep=["id"])
    g = {r.id for r in good.collect()}
    d = {r.id: r.reason for r in dead.collect()}
    assert g | set(d) == {m[0] for m in MESSAGES}
    assert not g & set(d)
    assert g == {1, 2}
    assert d[7] == "null"
    assert d[8] == "malformed" and d[10] == "malformed"
    assert d[9] == "missing:productNo"


def test_good_rows_are_typed(spark):
    df = spark.createDataFrame(MESSAGES[:1], "id int, value string")
    good, _ = decode(df, "value", PRODUCT_EVENT, keep=["id"])
    row = good.first()
    assert row.productNo == 7 and row.locTerm == "12"
    assert good.schema["productNo"].dataType == T.IntegerType()


def test_binary_values_are_read_as_text(spark):
    """A topic delivers the value as bytes; only the value is decoded, the key ignored."""
    from dimweave.sources.messages import message_text

    rows = [(bytearray(b"k1"), bytearray(b'{"productNo": 5, "locTerm": "12D"}'))]
    df = spark.createDataFrame(rows, "key binary, value binary")
    good, dead = decode(df, message_text(df), PRODUCT_EVENT, required=["productNo"])
    assert dead.count() == 0
    r = good.first()
    assert (r.productNo, r.locTerm) == (5, "12D")
