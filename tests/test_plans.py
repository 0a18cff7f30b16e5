"""Plan shape: the properties that matter at scale, read from the physical plans."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimweave.operators.ordered import keyed_scan
import __spark_entry__ as entry


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_row_shuffle_for_change_detection_and_versions(spark):
    plan = _plan(entry.queries()["q09_account_scd2"](spark, SF_SMALL))
    row_shuffles = re.findall(r"Exchange hashpartitioning\(id#\d+L?, _dw_chunk", plan)
    assert len(row_shuffles) == 1, plan  # both scans share the (key, chunk) partitioning


def test_hot_keys_split_and_carry_broadcast(spark):
    rows = [(0 if i % 3 == 0 else i % 500 + 1, i, i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, seq long, v int")
    out = keyed_scan(df, ["k"], ["seq"], prev={"p": F.col("v")}, chunk_rows=100)
    plan = _plan(out)
    specs = re.findall(r"windowspecdefinition\(([^)]*)\)", plan)
    assert specs
    for spec in specs:
        # over rows: partitioned by (key, chunk); over the carry table: by key, ordered by chunk
        assert "_dw_chunk" in spec, spec
    assert "BroadcastExchange" in plan
    assert out.filter(F.col("_dw_hot")).count() == 1000  # only the hot key is chunked


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = _plan(entry.queries()["q08_account_rate"](spark, SF_SMALL))
    assert "Not(EqualTo(c_mktsegment,MACHINERY))" in plan  # the lookup's filter reaches the reader
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<event_id:bigint,user_id:bigint>" in schemas


def test_no_python_in_batch_plans(spark):
    for name in ["q06_account_changes", "q09_account_scd2", "q12_product_scd2", "q14_rates_before",
                 "q15_rates_final", "q16_product_keys", "q17_fact_rows"]:
        plan = _plan(entry.queries()[name](spark, SF_SMALL))
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_hot_scd2_moves_rows_once(spark, small_chunks):
    """With every key hot, SCD2 still shuffles rows once: every other (key, chunk)
    exchange sits on a partial aggregation (chunk summaries only)."""
    plan = _plan(entry.queries()["q09_account_scd2"](spark, SF_SMALL))
    lines = plan.split("\n")
    row_exchanges = 0
    for i, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning\(id#\d+L?, _dw_chunk", line):
            child = lines[i + 1] if i + 1 < len(lines) else ""
            if "Aggregate" not in child:
                row_exchanges += 1
    assert row_exchanges == 1, plan
