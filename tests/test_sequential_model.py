"""Set-based operators against one-event-at-a-time models on random events."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimweave.operators.rates import FILL, OVERWRITE, rates_before, rates_final
from dimweave.operators.scd2 import scd2_versions
from dimweave.plans import jobs
from seqmodel import account_model, product_model, rate_model


def _events(rnd, n, keys, hot=0.3):
    out = []
    for i in range(n):
        k = 0 if rnd.random() < hot else rnd.randint(1, keys)
        out.append((k, 10 * i + rnd.randint(0, 5)))
    return out


@pytest.mark.parametrize("close", ["standard", "all_rows"])
@pytest.mark.parametrize("chunk_rows", [6, 1_000_000])
def test_account_versions(spark, close, chunk_rows):
    rnd = random.Random(7)
    evs = [{"id": k, "seq": s, "prt_code": rnd.choice(["32", "21", "35", "99"]),
            "op_type": rnd.choice(["A", "A", "D"])} for k, s in _events(rnd, 600, 30)]
    seed = []
    for k in range(0, 35, 2):
        seed.append({"id": k, "eff_seq": -5, "end_seq": None, "rate": Decimal(k), "new": False})
    for k in range(0, 35, 3):
        seed.append({"id": k, "eff_seq": -9, "end_seq": -5, "rate": None, "new": False})
    az = {k: (None if k % 4 == 0 else Decimal(100 + k)) for k in range(0, 35, 5)}
    accr = {k: f"x#{k}.5" for k in range(0, 35, 3)}
    expected = account_model(evs, seed, az, {k: Decimal(f"{k}.5") for k in accr}, close)

    ev_df = spark.createDataFrame([(e["id"], e["seq"], e["prt_code"], e["op_type"]) for e in evs],
                                  "id long, seq long, prt_code string, op_type string")
    ev_df = ev_df.withColumn("ts", F.timestamp_seconds("seq").cast("timestamp_ntz")).withColumn("ccy", F.lit("VND"))
    seed_df = spark.createDataFrame(
        [(r["id"], "S", "VND", "1", r["rate"], "O", r["eff_seq"], r["end_seq"]) for r in seed],
        "id long, account_type string, ccy string, cr_gl string, rate decimal(38,10), record_stat string, "
        "eff_seq long, end_seq long")
    seed_df = (seed_df.withColumn("eff_ts", F.timestamp_seconds("eff_seq").cast("timestamp_ntz"))
               .withColumn("end_ts", F.timestamp_seconds("end_seq").cast("timestamp_ntz")))
    az_df = spark.createDataFrame([(k, v) for k, v in az.items()], "id long, interest_rate decimal(38,10)")
    accr_df = spark.createDataFrame([(k, v) for k, v in accr.items()], "account_number long, cr_int_rate string")
    got = jobs.account_versions(ev_df, seed_df, az_df, accr_df, close=close, chunk_rows=chunk_rows)
    got_rows = sorted((r.id, r.eff_seq, r.end_seq, r.rate, r.is_new) for r in got.collect())
    exp_rows = sorted((r["id"], r["eff_seq"], r["end_seq"], r["rate"], r["new"]) for r in expected)
    assert got_rows == exp_rows


@pytest.mark.parametrize("close", ["standard", "all_rows"])
@pytest.mark.parametrize("chunk_rows", [5, 1_000_000])
def test_product_versions(spark, close, chunk_rows):
    rnd = random.Random(11)
    choices = [("SHORTTERM", "C0"), ("LONGTERM", "C0"), ("SHORTTERM", "C1"), (None, "C1")]
    evs = [{"product_no": k, "seq": s, "attrs": (*rnd.choice(choices), "S1", rnd.choice("AAD"))}
           for k, s in _events(rnd, 700, 25)]
    seed = [{"product_no": k, "eff_seq": -5, "end_seq": None, "attrs": ("SHORTTERM", "C0", "S1", "A"),
             "new": False} for k in range(0, 30, 2)]
    seed += [{"product_no": k, "eff_seq": -9, "end_seq": -5, "attrs": ("LONGTERM", "C0", "S1", "A"), "new": False}
             for k in range(0, 30, 3)]
    expected = product_model(evs, seed, close)
    cols = "product_no int, seq long, product_category string, product_code string, product_type string, " \
           "record_stat string"
    ev_df = spark.createDataFrame([(e["product_no"], e["seq"], *e["attrs"]) for e in evs], cols)
    seed_df = spark.createDataFrame([(r["product_no"], r["eff_seq"], r["end_seq"], *r["attrs"]) for r in seed],
                                    "product_no int, eff_seq long, end_seq long, product_category string, "
                                    "product_code string, product_type string, record_stat string")
    got = scd2_versions(ev_df, ["product_no"], ["seq"], jobs.PRODUCT_ATTRS, jobs.PRODUCT_ATTRS, seed=seed_df,
                        compare_with_seed=True, close=close, stamp_when="open", chunk_rows=chunk_rows)
    got_rows = sorted((r.product_no, r.eff_seq, r.end_seq, (r.product_category, r.product_code, r.product_type,
                                                             r.record_stat), r.is_new) for r in got.collect())
    exp_rows = sorted((r["product_no"], r["eff_seq"], r["end_seq"], r["attrs"], r["new"]) for r in expected)
    assert got_rows == exp_rows


@pytest.mark.parametrize("chunk_rows", [4, 1_000_000])
def test_rates(spark, chunk_rows):
    rnd = random.Random(3)
    events = []
    for k, s in _events(rnd, 900, 60, hot=0.3):
        rate = None if rnd.random() < 0.25 else Decimal(rnd.randint(1, 99))
        events.append((s, k, rate, rnd.choice([OVERWRITE, FILL])))
    dim = {k: (None if k % 3 == 0 else Decimal(1000 + k)) for k in range(0, 55)}
    exp_before, exp_final = rate_model(events, dim)
    ev_df = spark.createDataFrame([(k, s, r, src) for s, k, r, src in events],
                                  "account_no long, seq long, rate decimal(38,10), source string")
    dim_df = spark.createDataFrame(list(dim.items()), "account_no long, rate decimal(38,10)")
    before = rates_before(ev_df, dim_df, key="account_no", order=["seq"], dim_key="account_no", dim_rate="rate",
                          chunk_rows=chunk_rows)
    assert {r.seq: r.rate_before for r in before.collect()} == exp_before
    final = rates_final(ev_df, dim_df, key="account_no", order=["seq"], dim_key="account_no", dim_rate="rate")
    assert {r.account_no: r.rate for r in final.collect()} == exp_final
