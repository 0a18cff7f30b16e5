"""Messages written to files (the topic stand-in) read back as the same rows."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimweave.plans import fixtures as fx
from dimweave.schemas import PRODUCT_EVENT
from dimweave.sources.messages import decode
from dimweave.streaming.sinks import messages, write_files


def test_messages_round_trip(spark):
    p = fx.fx_product(spark, SF_SMALL).select(
        F.col("product_no").alias("productNo"), F.col("loc_term").alias("locTerm"), "category",
        F.col("sub_product").alias("subProduct"), F.col("op_type").alias("opType"))
    msgs = messages(p, "productNo")
    out = tempfile.mkdtemp(prefix="dw-msgs-") + "/m"
    write_files(msgs, out)
    back = spark.read.json(out, schema="key string, value string")
    good, dead = decode(back, "value", PRODUCT_EVENT, required=["productNo"])
    assert dead.count() == 0
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(map(tuple, p.collect()), key=repr)
    # null fields are written as JSON nulls, not dropped
    assert back.filter(F.col("value").contains('"locTerm":null')).count() == p.filter(F.col("locTerm").isNull()).count()
