"""Property tests: small random inputs (including empty ones, single keys, nulls and tiny
chunks) against the one-event-at-a-time models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dimweave.operators.scd2 import scd2_versions
from dimweave.plans import jobs
from seqmodel import product_model

ATTRS = st.tuples(st.sampled_from(["SHORTTERM", "LONGTERM", None]), st.sampled_from(["C0", "C1"]),
                  st.just("S1"), st.sampled_from(["A", "D"]))

EVENTS = st.lists(st.tuples(st.integers(0, 3), ATTRS), max_size=40)
SEEDED = st.sets(st.integers(0, 4), max_size=4)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=EVENTS, seeded=SEEDED, chunk_rows=st.sampled_from([1, 3, 1_000_000]),
       close=st.sampled_from(["standard", "all_rows"]))
def test_product_versions_match_model(spark, events, seeded, chunk_rows, close):
    evs = [{"product_no": k, "seq": i, "attrs": a} for i, (k, a) in enumerate(events)]
    seed = [{"product_no": k, "eff_seq": -5, "end_seq": None, "attrs": ("SHORTTERM", "C0", "S1", "A"), "new": False}
            for k in sorted(seeded)]
    expected = product_model(evs, seed, close)
    cols = ("product_no int, seq long, product_category string, product_code string, product_type string, "
            "record_stat string")
    ev_df = spark.createDataFrame([(e["product_no"], e["seq"], *e["attrs"]) for e in evs], cols)
    seed_df = spark.createDataFrame([(r["product_no"], r["eff_seq"], r["end_seq"], *r["attrs"]) for r in seed],
                                    "product_no int, eff_seq long, end_seq long, product_category string, "
                                    "product_code string, product_type string, record_stat string")
    got = scd2_versions(ev_df, ["product_no"], ["seq"], jobs.PRODUCT_ATTRS, jobs.PRODUCT_ATTRS, seed=seed_df,
                        compare_with_seed=True, close=close, stamp_when="open", chunk_rows=chunk_rows)
    got_rows = sorted(((r.product_no, r.eff_seq, r.end_seq, (r.product_category, r.product_code, r.product_type,
                                                              r.record_stat), r.is_new) for r in got.collect()),
                      key=repr)
    exp_rows = sorted(((r["product_no"], r["eff_seq"], r["end_seq"], r["attrs"], r["new"]) for r in expected),
                      key=repr)
    assert got_rows == exp_rows
