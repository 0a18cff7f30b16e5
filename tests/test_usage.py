"""The README's usage path end to end: entity-layout messages -> decode -> account
dimension, on the fixture tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimweave.plans import fixtures as fx
from dimweave.plans import jobs
from dimweave.schemas import ACCOUNT_EVENT
from dimweave.sources import decode, message_text


def test_messages_to_account_dimension(spark):
    raw = fx.fx_account_messages(spark, SF_SMALL).withColumn("offset", F.col("key").cast("bigint"))
    good, dead = decode(raw, message_text(raw), ACCOUNT_EVENT, required=["id", "prtCode", "opType"],
                        keep=["offset"])
    assert dead.filter(F.col("reason") != "missing:prtCode").count() == 0
    events = (jobs.account_events_from_messages(good).withColumnRenamed("offset", "seq")
              .withColumn("id", F.col("id").cast("bigint"))
              .withColumn("ts", F.timestamp_seconds("seq").cast("timestamp_ntz")))
    dim = jobs.account_versions(events, fx.fx_dim_account(spark, SF_SMALL), fx.fx_az(spark, SF_SMALL),
                                fx.fx_accr(spark, SF_SMALL))
    new = dim.filter(F.col("is_new"))
    # one new version per event that differs in any field from the one before it
    from dimweave.operators import changed_rows, drop_scan_columns
    assert new.count() == drop_scan_columns(changed_rows(events, ["id"], ["seq"], jobs.ACCOUNT_COMPARE)).count()
